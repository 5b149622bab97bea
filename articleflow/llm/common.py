"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of an Arrow batch, beyond one row: a task that reads texts in Python
#: holds no more of them at a time.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; from here on the session's Arrow batches are small
    (a setting of the session, so that long texts do not add up in a worker)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, as UTF-8 bytes (bytes.lower and
    bytes.split know only ASCII letters and ASCII white space)."""
    return text.encode().lower().split() if text else []


class Bitmap:
    """A fixed-size set of 64-bit keys with false positives and no false
    negatives: bit ``key mod 2**bits``.  Its size (2**bits / 8 bytes) does not
    depend on the data, so it may be broadcast; when it fills up it only stops
    pruning, results stay the same because a join follows it."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def __contains__(self, key: int) -> bool:
        return bool(self.test(np.array([key], np.uint64))[0])

    def test(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64((1 << self.bits) - 1)
        return (self.words[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def bitmap(df: DataFrame, key: str, bits: int = 26) -> Bitmap:
    """Bitmap of a long column, built with Spark's bitmap aggregate: one row of
    4 KB for each 32,768 bits reaches the driver (8 MB in all at 26 bits)."""
    at = F.col(key).bitwiseAND((1 << bits) - 1)
    rows = df.where(F.col(key).isNotNull()).select(at.alias("__at")) \
        .groupBy(F.expr("bitmap_bucket_number(__at + 1)").alias("b")) \
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(__at + 1))").alias("m")).collect()
    words = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        start = (r["b"] - 1) * 4096
        words[start:start + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return Bitmap(words, bits)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(lists: Iterable[int], total: int) -> np.ndarray:
    """Row number of each element of consecutive lists of the given lengths."""
    return np.repeat(np.arange(total), np.fromiter(lists, np.int64, total))
