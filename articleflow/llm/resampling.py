"""Target-distribution importance resampling: documents whose hashed word
n-grams look like a target corpus are drawn more often, by the Gumbel top-k
trick (largest log importance weight plus seeded Gumbel noise, without
replacement).

Method:

1. Features of a text are all runs of 1 to ORDER consecutive words; a feature's
   bucket is its CRC-32 modulo BUCKETS.  Bucket counts are summed over all
   documents and over all target texts by Spark; each count table has BUCKETS
   rows, whatever the corpus.  They give an array with one integer gain for
   each bucket.
2. A document's weight is the sum of its features' gains: array look-ups.
3. Parallel sorting by regular sampling.  Each task sorts the documents it has
   scored into runs of at most RUN rows and writes them with their place in
   the run.  Every ``step``-th row of each run is a regular sample; every
   regular sample of the sorted samples is a splitter.  Runs are cut at the
   splitters, prefix sums of the segments' sizes give each segment's first
   rank, and the segments that hold drawn documents are exchanged and merged
   locally, so that first rank plus place is the exact rank.  Segments beyond
   the draw stay where they are.

A row's order is (score descending, doc_id, run, place in run): no two rows
are equal in it, so rows that repeat a doc_id (a third of the table, say) are
cut by splitters like any others.

Defined cases: a null text holds no word; texts without words have no feature,
weight 0 and a score from the noise alone; a null doc_id counts as the empty
string in the hash and comes after all ids among ties; rows that repeat a
doc_id are documents of their own with the same noise; without any target text
all gains come from T = t = 0; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import table

BUCKETS = 10000
ORDER = 3
SEED = 42
PERCENT, MIN_WORDS = 5, 20
#: Rows of a sorted run, and of a segment (as far as SAMPLES splitters allow).
RUN, SEGMENT = 1 << 18, 1 << 14
#: Regular samples that reach the driver, and splitters at most.
SAMPLES = 1 << 16
#: Samples that a run of mean length gives at least.
PER_RUN = 64

#: Lower-cases A-Z and turns every other ASCII byte outside words to a blank;
#: bytes of other characters (from 0x80) stay.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: lower-cased runs of ASCII letters, digits and all other
    characters from U+0080, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


def buckets_of(words: list[bytes], order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all runs of 1 to ``order`` words, repeats included.  The CRC
    of a longer run goes on from that of the run without its last word."""
    sums = list(map(crc32, words))
    out, later = list(sums), [b" " + w for w in words]
    for n in range(1, min(order, len(words))):
        sums = list(map(crc32, later[n:], sums))
        out += sums
    return np.array(out, np.int64) % buckets


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in column ``text``, over all rows: each task
    counts into an array, Spark sums the arrays bucket by bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for text in b["text"]:
                total += np.bincount(buckets_of(words_of(text), order, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"b": at, "n": total[at]})
    counts = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInPandas(run, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        counts[r["b"]] = r["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Integer gain of each bucket: 1000 times the log ratio of its smoothed
    shares in the target and in the corpus, rounded down."""
    size, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
                     for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """Seeded Gumbel noise of a document in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_ROWS = "doc_id long, none boolean, n_features long, weight long, score long, ok boolean, run long, at long"


def _sorted_runs(docs: DataFrame, gain: np.ndarray, order: int, min_words: int, seed: int, size: int) -> DataFrame:
    """Scored documents in runs sorted by (ok first, score descending, doc_id);
    ``none`` marks a null doc_id, ``at`` is the place in the run.  A run is
    named by its task and number, so a task that is run again writes the same
    rows."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush() -> pd.DataFrame:
            nonlocal number
            out = pd.DataFrame(rows, columns=["doc_id", "none", "n_features", "weight", "score", "ok"])
            out = out.iloc[np.lexsort([out["doc_id"], out["none"], -out["score"], ~out["ok"]])]
            number += 1
            return out.assign(run=(TaskContext.get().partitionId() << 24) + number, at=np.arange(len(out)))
        rows, number, values = [], 0, shared.value
        for b in batches:
            for doc_id, none, text in zip(b["doc_id"].tolist(), b["none"].tolist(), b["text"]):
                words = words_of(text)
                found = buckets_of(words, order, len(values))
                weight = int(values[found].sum())
                rows.append((doc_id, none, len(found), weight, weight + noise(None if none else doc_id, seed), len(words) >= min_words))
                if len(rows) == size:
                    yield flush()
                    rows = []
        if rows:
            yield flush()
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("none"), "text").mapInPandas(run, _ROWS)


#: A row's place in the common order: these columns, ascending.
_PLACE = ("key", "none", "doc_id", "run", "at")


def regular_splitters(runs: DataFrame, total: int, samples: int, segment: int) -> np.ndarray:
    """Places (rows of the five columns of the common order) that cut the runs
    into segments of about ``segment`` rows.  Each run gives its regular
    samples; where these are too many for the driver, groups of neighbouring
    runs are sorted and thinned regularly once more, so that about ``samples``
    rows reach it in all."""
    count = runs.agg(F.count_distinct("run")).first()[0]
    step = max(1, -(-total // samples))
    fine = min(step, max(1, total // max(1, count) // PER_RUN))
    picked = runs.where(F.col("at") % fine == fine - 1).select((-F.col("score")).alias("key"), *_PLACE[1:])
    thin = step // fine
    if thin > 1:
        def regular(pdf: pd.DataFrame) -> pd.DataFrame:
            return pdf.sort_values(list(_PLACE)).iloc[thin - 1::thin]
        picked = picked.groupBy(F.shiftright("run", 36)).applyInPandas(regular, "key long, none boolean, doc_id long, run long, at long")
    rows = np.array([tuple(r) for r in picked.collect()], np.int64).reshape(-1, len(_PLACE))
    rows = rows[np.lexsort(rows.T[::-1])]
    every = max(1, segment // (fine * max(1, thin)))
    return rows[every - 1::every]


def _segments(runs: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``runs`` with the number of each row's segment: the splitters before it
    (a splitter's own row ends its segment)."""
    shared = runs.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cuts = shared.value
        for b in batches:
            own = np.stack([-b["score"], b["none"], b["doc_id"], b["run"], b["at"]], axis=1).astype(np.int64)
            both = np.concatenate([own, cuts])                      # of equal rows, the table's comes first
            order = np.lexsort([np.arange(len(both)) >= len(own), *both.T[::-1]])
            segment = np.empty(len(both), np.int64)
            segment[order] = np.cumsum(order >= len(own))
            yield b.assign(segment=segment[:len(own)])
    return runs.mapInPandas(run, _ROWS + ", segment long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, order: int = ORDER, buckets: int = BUCKETS,
             seed: int = SEED, run_rows: int = RUN, samples: int = SAMPLES, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``
    (doc_id, text); ``rank`` numbers the ``percent`` % of the documents with at
    least ``min_words`` words that are drawn, others have none.  ``target``
    gives the target texts (column text)."""
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    scored = stage(_sorted_runs(docs, gain, order, min_words, seed, run_rows), "resample-runs")
    able = scored.where("ok")
    total = able.count()
    draw = percent * total // 100
    cuts = regular_splitters(able, total, samples, segment)
    cut_runs = stage(_segments(able, cuts), "resample-segments")
    sizes = {r["segment"]: r["n"] for r in cut_runs.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, before = [], 0
    for k in range(len(cuts) + 1):
        if before >= draw:
            break
        first.append((k, before))
        before += sizes.get(k, 0)
    starts = docs.sparkSession.createDataFrame(first, "segment long, first long")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.iloc[np.lexsort([pdf["at"], pdf["run"], pdf["doc_id"], pdf["none"], -pdf["score"]])]
        rank = out["first"].to_numpy() + np.arange(1, len(out) + 1)
        return out[["doc_id", "none", "n_features", "weight", "score"]].assign(rank=np.where(rank <= draw, rank, 0))
    near = cut_runs.join(F.broadcast(starts), "segment")          # at most ``samples`` rows
    ranked = near.groupBy("segment").applyInPandas(merge, "doc_id long, none boolean, n_features long, weight long, score long, rank long")
    rest = cut_runs.where(F.col("segment") >= len(first)).drop("segment").unionByName(scored.where(~F.col("ok"))).withColumn("rank", F.lit(0))
    both = ranked.unionByName(rest.select(*ranked.columns))
    return both.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "n_features", "weight", "score",
                       F.when(F.col("rank") > 0, F.col("rank")).cast("long").alias("rank"))


def op11_resampling(spark, sf_dir):
    """doc_id, n_features, weight, score, rank of every document, with the
    benchmark texts as the target."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
