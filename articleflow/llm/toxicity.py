"""Toxicity scores.

Method: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams; per-coordinate rates and L1 sparsity produce compact weights that
are broadcast (at most 2**BITS coordinates, so their size is bounded).

Features of a text: each distinct word, pair of neighbours, pair with one word
between (skip-gram), and the beginnings of words (HEADS characters), all hashed into
2**BITS coordinates, each with value 1 (how often does not count, so that
neither repeats nor long texts drown a feature).  Words are lower-cased runs
of letters and digits.

Training sees labelled documents only: all of them up to ``max_train``
(documented bound of the sample), else those of the smallest hash of doc_id,
in an order by that hash; the bound makes one task enough.  The intercept has
no penalty.  Scoring covers every whole text.

Defined cases: null and empty texts have no feature and score the intercept
alone; without any usable label all weights are 0 and every score is 0.5; a
doc_id labelled more than once trains with each label; rows that repeat a
doc_id are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, table

BITS = 20
HEADS = (3, 4, 5, 6)
MAX_TRAIN = 12000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.0
THRESHOLD = 0.7

_NOT_WORD = re.compile(r"[\W_]+")


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct coordinates of a text."""
    words = _NOT_WORD.sub(" ", text.lower()).split() if text else []
    if not words:
        return np.empty(0, np.int64)
    known = {x: crc32(x.encode()) for x in set(words)}
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    heads = np.fromiter((crc32(x.encode()) for x in {x[:n] for n in HEADS for x in known if len(x) > n}), np.uint64)
    step, skip = np.uint64(0x9E3779B1), np.uint64(0x85EBCA77)
    kinds = (np.unique(w), np.unique(w[:-1] * step + w[1:]), np.unique(w[:-2] * skip + w[2:]), heads)
    keys = np.concatenate([mix64(k + np.uint64(n << 40)) for n, k in enumerate(kinds)])
    return np.unique((keys >> np.uint64(64 - bits)).astype(np.int64))


class Ftrl:
    """FTRL-proximal (McMahan et al., "Ad Click Prediction: a View from the
    Trenches", 2013): per-coordinate rates, L1 and L2."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = np.arange(len(self.z))[at] == len(self.z) - 1   # the intercept
        l1 = np.where(free, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g


def train(examples: DataFrame, max_train: int = MAX_TRAIN, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (2**bits coordinates and the intercept) from (doc_id, text,
    label).  Features are made where the texts are; one task then takes the
    examples' coordinates in the order of their hash and returns the nonzero
    weights."""
    chosen = examples.where("label is not null").select("text", "label", F.xxhash64(F.col("doc_id").cast("string"), F.lit("train")).alias("o"),
                                                        F.xxhash64("text").alias("t"))
    if max_train:
        edge = chosen.select("o").orderBy("o").limit(max_train).agg(F.max("o")).first()[0]
        chosen = chosen.where(F.col("o") <= F.lit(edge)) if edge is not None else chosen

    def coordinates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"o": b["o"], "t": b["t"], "label": b["label"],
                                "x": [features(t, bits).astype(np.int32).tobytes() for t in b["text"]]})

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(np.frombuffer(x, np.int32).copy(), int(y)) for b in batches for x, y in zip(b["x"], b["label"])]
        model = Ftrl(bits)
        for _ in range(epochs):
            for at, label in rows:
                model.learn(at, label)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pd.DataFrame({"at": at, "w": w[at]})

    made = chosen.mapInPandas(coordinates, "o long, t long, label int, x binary")
    out = np.zeros((1 << bits) + 1)
    # one task, read as a stream: it keeps the coordinates of at most max_train examples (without it: of all)
    one = made.repartition(1).sortWithinPartitions("o", "t", "label").select("label", "x")
    for r in one.mapInPandas(fit, "at long, w double").collect():
        out[r["at"]] = r["w"]
    return out


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """(doc_id, __t, score): the probability of label 1 of every row."""
    at = np.flatnonzero(weights)
    sparse = docs.sparkSession.sparkContext.broadcast((at, weights[at]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.zeros((1 << bits) + 1)
        w[sparse.value[0]] = sparse.value[1]
        for b in batches:
            sums = np.array([w[features(t, bits)].sum() for t in b["text"]], float) + w[-1]
            yield b[["doc_id", "__t"]].assign(score=1 / (1 + np.exp(-np.clip(sums, -35, 35))))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("__t"), "text")
    return rows.mapInPandas(run, "doc_id long, __t long, score double")


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, **how) -> np.ndarray:
    """Weights learned from ``labels.toxic`` of the documents not held out."""
    marks = labels.select(F.col("doc_id").alias("__d"), F.col("toxic").cast("int").alias("label"))
    rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))).join(marks, F.col("doc_id") == F.col("__d"))
    return train(rows.select("doc_id", "text", "label"), **how)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more: rows are
    judged where they are read, as Arrow batches, so nothing is shuffled."""
    weights = fit_on_labels(docs, labels)
    at = np.flatnonzero(weights)
    sparse = docs.sparkSession.sparkContext.broadcast((at, weights[at]))

    def run(batches):
        import pyarrow as pa
        w = np.zeros((1 << bits) + 1)
        w[sparse.value[0]] = sparse.value[1]
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))          # one Python string at a time
            keep = [1 / (1 + np.exp(-np.clip(w[features(t.as_py(), bits)].sum() + w[-1], -35, 35))) < threshold for t in texts]
            yield b.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark, sf_dir):
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit_on_labels(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
