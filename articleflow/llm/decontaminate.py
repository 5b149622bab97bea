"""Benchmark decontamination.

Method: rare n-gram seeds join training passages to test items, then
Smith-Waterman alignment scores paraphrased or edited copies.

Words are lower-cased runs of letters and digits.  Seeds are word 2-grams of
an item, the rarest by their document frequencies over the whole corpus (ties
by hash), as many as the score bound asks for: an alignment of score S has at
most S fewer breaks than matches, so it holds S - 1 or more of the item's
n - 1 gram places unbroken, and any n + 1 - S places of the item include one
of these.  No leak is lost, however its changed words, gaps and insertions lie
(3-grams cannot promise that: every second place may hold an insertion), and
grams that no document holds may rank first, as they are counted as lost.
Phrases of everyday words come last and are seeds only of items that have
little else.  Each (document, item) pair that shares a seed is aligned, where
S - 1 or more gram places of the item occur: the document's stretches around the seed hits (twice the item's
length on either side, overlapping ones merged) against the item, word by
word, +1 for a match, -1 for a mismatch or a gap.  The score is the best local
alignment divided by the item's number of words; a pair from ``MIN_SCORE``
(at most a quarter of the words changed) is a leak.

Texts are read twice and never shuffled but for the candidates: the first pass
gives the grams that may belong to an item, the second the documents that may
hold a seed, with the places (a fixed-size bitmap discards the others; the
joins behind it are exact).  Only these documents meet their items.

Defined cases: null and empty texts, and items of under three words, give no
pair; an item repeated under the same item_id is compared once per distinct
text and the best score counts; rows that repeat a doc_id are one document
whose best score counts; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import Bitmap, bitmap, mix64, table

GRAM = 2
#: Items of fewer words give no pair.
MIN_WORDS = 3
MIN_SCORE = 0.5
_NOT_WORD = re.compile(r"[\W_]+")


def words_of(text: str | None) -> list[str]:
    return _NOT_WORD.sub(" ", text.lower()).split() if text else []


def gram_hashes(words: list[str], n: int = GRAM) -> np.ndarray:
    """64-bit hash of each n-gram, in order."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    w = mix64(np.fromiter((crc32(x.encode()) for x in words), np.uint64, len(words)))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ w[k:len(words) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(h)


def needed(words: int, min_score: float) -> int:
    """Gram places of an item that an alignment of ``min_score`` leaves whole."""
    return int(np.ceil(min_score * words - 1e-9)) - 1


def _item_grams(items: DataFrame, min_score: float) -> DataFrame:
    """(item_id, __i, g, places, lost): the distinct grams of every item, the
    places of each, and how many places of the item a leak may lose."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, gram, places, lost = [], [], [], []
            for k, text in enumerate(b["text"]):
                words = words_of(text)
                h, n = np.unique(gram_hashes(words) if len(words) >= MIN_WORDS else np.empty(0, np.uint64), return_counts=True)
                row.append(np.full(len(h), k))
                gram.append(h.view(np.int64))
                places.append(n)
                lost.append(np.full(len(h), len(words) - 1 - needed(len(words), min_score)))
            if row:
                yield b[["item_id", "__i"]].iloc[np.concatenate(row)].reset_index(drop=True).assign(
                    g=np.concatenate(gram), places=np.concatenate(places), lost=np.concatenate(lost))
    return items.select("item_id", "__i", "text").mapInPandas(run, f"item_id {kind}, __i long, g long, places long, lost long")


#: Gram hashes that a task gathers before it counts them.
GATHER = 1 << 20


def _frequencies(docs: DataFrame, keep: Bitmap) -> DataFrame:
    """(g, df): the documents that hold each gram that ``keep`` lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def counted() -> pd.DataFrame:
            g, n = np.unique(np.concatenate(found), return_counts=True)
            return pd.DataFrame({"g": g.view(np.int64), "n": n})
        found, size = [], 0
        for b in batches:
            for text in b["text"]:
                h = gram_hashes(words_of(text))
                found.append(np.unique(h[shared.value.test(h)]))
                size += len(found[-1])
                if size >= GATHER:
                    yield counted()
                    found, size = [], 0
        if found:
            yield counted()
    return docs.select("text").mapInPandas(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("df"))


def _candidates(docs: DataFrame, keep: Bitmap) -> DataFrame:
    """(doc_id, __t, text, hits): the documents with grams that ``keep`` lets
    through, and where each of these grams stands."""
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hits: list[list | None] = []
            for text in b["text"]:
                h = gram_hashes(words_of(text))
                at = np.flatnonzero(shared.value.test(h))
                places: dict[int, list[int]] = {}
                for g, p in zip(h[at].view(np.int64).tolist(), at.tolist()):
                    places.setdefault(g, []).append(p)
                hits.append([{"g": g, "at": p} for g, p in places.items()] or None)
            out = b.assign(hits=hits)
            yield out[out["hits"].notna()]
    return docs.mapInPandas(run, "doc_id long, __t long, text string, hits array<struct<g:long,at:array<int>>>")


def seeds(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(item_id, __i, g): the rarest grams of each item, by the number of
    documents that hold them, that cover more places than a leak may lose."""
    own = stage(_item_grams(items, min_score), "bench-grams")
    ranked = own.join(_frequencies(docs, bitmap(own, "g")), "g", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rarer = Window.partitionBy("item_id", "__i").orderBy("df", "g").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.withColumn("covered", F.coalesce(F.sum("places").over(rarer), F.lit(0))) \
        .where(F.col("covered") <= F.col("lost")).select("item_id", "__i", "g")


def align(a: np.ndarray, b: np.ndarray) -> int:
    """Best Smith-Waterman score of two sequences of word numbers (+1 match, -1
    mismatch, -1 gap).  One step per word of ``a``; gaps along ``b`` come from
    a running maximum, which is exact for a linear gap cost."""
    slope = np.arange(1, len(b) + 1)
    last, best = np.zeros(len(b) + 1, np.int64), 0
    for x in a:
        h = np.maximum(last[:-1] + np.where(b == x, 1, -1), last[1:] - 1)
        h = np.maximum.accumulate(np.maximum(h, 0) + slope) - slope
        last[1:] = h
        best = max(best, int(h.max(initial=0)))
    return best


def best_alignment(words: list[str], item: list[str], hits, min_score: float = MIN_SCORE) -> float:
    """Alignment score of an item in the stretches of a text around the hits;
    stretches with too few of the item's grams for ``min_score`` count as 0."""
    reach, ids = 2 * len(item), {}
    a = np.array([ids.setdefault(w, len(ids)) for w in item])
    own, least = a[:-1] * len(item) + a[1:], needed(len(item), min_score)
    hits, start, best = sorted(hits), 0, 0
    while start < len(hits):
        end = start
        while end + 1 < len(hits) and hits[end + 1] - hits[end] <= 2 * reach:
            end += 1
        part = np.array([ids.get(w, -1) for w in words[max(0, hits[start] - reach):hits[end] + reach + GRAM]])
        held = (part[:-1] * len(item) + part[1:])[(part[:-1] >= 0) & (part[1:] >= 0)]
        if np.isin(own, held).sum() >= least:
            best = max(best, align(a, part))
        start = end + 1
    return best / len(item)


def leaks(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score) of the leaks of ``items`` (item_id, text) in
    ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("__t"), "text")
    items = items.select("item_id", F.xxhash64("text").alias("__i"), "text").where("text is not null").distinct()
    chosen = stage(seeds(docs, items, min_score), "bench-seeds")
    held = stage(_candidates(docs, bitmap(chosen, "g")), "bench-candidates")
    found = held.select("doc_id", "__t", F.explode("hits").alias("h")).select("doc_id", "__t", F.col("h.g").alias("g"), F.col("h.at").alias("at"))
    pairs = found.join(chosen, "g").groupBy("doc_id", "__t", "item_id", "__i").agg(F.flatten(F.collect_set("at")).alias("at"))
    texts = items.select(F.col("item_id").alias("__id"), F.col("__i").alias("__j"), F.col("text").alias("item"))
    whole = pairs.join(texts, F.col("item_id").eqNullSafe(F.col("__id")) & (F.col("__i") == F.col("__j")))
    todo = stage(whole.groupBy(F.col("doc_id").alias("__d"), F.col("__t").alias("__u"))
                 .agg(F.collect_list(F.struct("item_id", "item", "at")).alias("items")), "bench-pairs")
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, text, todo in zip(b["doc_id"], b["text"], b["items"]):
                words = words_of(text)
                for x in todo:
                    s = best_alignment(words, words_of(x["item"]), x["at"], min_score)
                    if s >= min_score:
                        out.append((d, x["item_id"], s))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "score"])
    both = held.join(todo, held["doc_id"].eqNullSafe(todo["__d"]) & (held["__t"] == todo["__u"]))
    scored = both.select("doc_id", "text", "items").mapInPandas(run, f"doc_id long, item_id {kind}, score double")
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def decontaminate(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the documents that hold a leak."""
    bad = stage(leaks(docs, items, min_score).select(F.col("doc_id").alias("__d")).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__d"]), "left_anti")


def op5_decontamination(spark, sf_dir):
    """doc_id, item_id, score of every leak of a benchmark item in a document."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
