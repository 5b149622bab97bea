"""SimHash near-dedup.

Method: tiled exact comparison with numpy exclusive-or and bit counts,
skipping tile pairs whose population counts differ beyond the radius.

Fingerprint: words are A-Z lower-cased runs of anything but ASCII white space;
a shingle is three neighbouring words joined by a space (repeats count; fewer
words: the whole sequence); h is the XXH64 (seed 42) of its UTF-8 bytes; a bit
is 1 if it is set in over half the h; no words give 0.  Fingerprints link at
``radius`` or fewer differing bits; classes are the connected components.

Which tiles meet: of five bit blocks, three differing bits leave at least two
blocks equal, so fingerprints within the radius agree on one of the ten pairs
of blocks (about 26 bits).  Equal fingerprints collapse first; those that agree
on a pair of blocks form a group, whose tiles are compared exactly, by
population count.  The comparisons thus grow with the near copies and not with
the square of the table; no link is lost and none is approximate.  A group of
any size is dealt into tile pairs (tiles.py), which give back spanning links
only.

Defined cases: null and empty texts have fingerprint 0 and link like any
other; rows that repeat a doc_id are rows of their own and share its class; a
null doc_id never names a class unless its whole class has none; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import stage
from .common import ascii_words, table
from .tiles import Links, tile_pairs

SHINGLE = 3
RADIUS = 3
#: Shingles hashed at a time, so that a very long text needs no more memory.
CHUNK = 1 << 18
#: Rows of a block of a tile pair.
BLOCK = 512


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text."""
    import xxhash
    words = ascii_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    h64 = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        part = words[start:start + CHUNK + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.array([h64(g, 42) for g in grams], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, __t, __fp): text hash and fingerprint (a signed long) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield b[["doc_id", "__t"]].assign(__fp=fp)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("__t"), "text")
    return rows.mapInPandas(run, "doc_id long, __t long, __fp long")


def _blocks(radius: int) -> list[list[int]]:
    """Masks: 64 bits in radius + 2 blocks, each pair of blocks one mask."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int)
    block = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    return [block[i] | block[j] for i, j in combinations(range(len(block)), 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near(a: np.ndarray, b: np.ndarray, radius: int = RADIUS, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a and b (uint64) within the radius.  Both are ordered by
    population count and cut into blocks; a pair of blocks whose counts differ
    by more than the radius is skipped, since each differing bit changes the
    count by one."""
    ca, cb = np.bitwise_count(a).astype(np.int16), np.bitwise_count(b).astype(np.int16)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    for i in range(0, len(a), block):
        x = oa[i:i + block]
        for j in range(0, len(b), block):
            y = ob[j:j + block]
            if cb[y[0]] - ca[x[-1]] > radius or ca[x[0]] - cb[y[-1]] > radius:
                continue
            p, q = np.nonzero(np.bitwise_count(a[x][:, None] ^ b[y][None, :]) <= radius)
            yield x[p], y[q]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``__fp`` within the radius."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, unit in pdf.groupby("__u", sort=False):
            fp, side = unit["__fp"].to_numpy().view(np.uint64), unit["__side"].to_numpy()
            at, found = np.arange(len(fp)), Links(len(fp))
            left, right = at[side == 0], at[side == 1]
            right = right if len(right) else left
            for p, q in near(fp[left], fp[right], radius):
                found.add(left[p], right[q])
            a, b = found.joined()
            out.append(pd.DataFrame({"a": fp[a].view(np.int64), "b": fp[b].view(np.int64)}))
        return pd.concat(out)
    keys = F.array(*[F.xxhash64(F.lit(n), F.col("__fp").bitwiseAND(F.lit(_signed(m)))) for n, m in enumerate(_blocks(radius))])
    members = fps.select("__fp", F.explode(keys).alias("__k"))
    return tile_pairs(members, "__k", F.col("__fp")).groupBy("__pack").applyInPandas(run, "a long, b long").distinct()


def simhash_classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, __t, __fp, __part, component_id) of every row of ``docs``
    (doc_id, text, ...): the text's hash, the fingerprint, the class by its
    smallest fingerprint and by its smallest doc_id."""
    rows = stage(fingerprints(docs, shingle), "simhash")
    fps = stage(rows.groupBy("__fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    parts = stage(connected_components(links(fps.select("__fp"), radius), "a", "b"), "simhash-parts")
    label = fps.join(parts, fps["__fp"] == parts["id"], "left") \
        .select("__fp", "first", F.coalesce("component", "__fp").alias("__part"))
    least = label.groupBy("__part").agg(F.min("first").alias("component_id"))
    return rows.join(label.join(least, "__part").drop("first"), "__fp") \
        .select("doc_id", "__t", "__fp", "__part", "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each class: the one of the smallest doc_id (a
    class without any: the one of the smallest text hash)."""
    classes = simhash_classes(docs, shingle, radius)
    firsts = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("__part", F.col("doc_id").alias("__d")).agg(F.min("__t").alias("__u"))
    keyed = docs.withColumn("__t", F.xxhash64("text"))
    kept = keyed.join(firsts, keyed["doc_id"].eqNullSafe(F.col("__d")) & (F.col("__t") == F.col("__u")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__t"]).drop("__t")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op2_simhash(spark, sf_dir):
    """doc_id, fingerprint, component_id of every document."""
    out = simhash_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", hex16(F.col("__fp")).alias("fingerprint"), "component_id")
