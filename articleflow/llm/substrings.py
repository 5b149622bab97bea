"""Suffix-array dedup: removes every byte covered by a ``length``-byte string
that also starts earlier (a smaller doc_id, or the same document further left).

Method: prefix-free parsing.  Rolling-hash triggers cut the texts into phrases
(phrases.py); the dictionary holds each distinct phrase with its first place
in corpus order; suffix arrays of the dictionary tell which strings of a
phrase's first place stand in another phrase that comes first.  In highly
repetitive text nearly all places hold phrases that stand earlier as a whole,
and these need no suffix at all.

The parse stays distributed: a phrase is named by its trigger's hash and its
own (64 bits each), its places are rows, and their order is that of (doc_id,
start), so one sorted parse of the whole corpus is never built.  Because equal
strings have the same trigger, the dictionary falls into one part for each
trigger, and a suffix array over whole parts is as good as one over all.
Matches are judged up to ``length`` bytes, so suffixes are sorted that far.

1. Count the places of each trigger (one long each, combined map-side).
2. Stage the phrases whose trigger occurs twice; the fixed-size bitmap of the
   triggers may let more through, never fewer.
3. Dictionary: the smallest doc_id of each phrase.  Any other place of it goes
   whole.
4. Triggers with several phrases ("contested"): fetch the phrases' bytes from
   their first documents; suffix arrays find the windows of each phrase that
   another phrase has earlier.  A trigger with more than ``PART`` phrases is
   compared window by window with Spark aggregates instead, so no task takes
   an unbounded part.
5. Join each document with its removals.

Defined cases: null counts as the empty text; texts shorter than ``length``
lose nothing; of rows with the same doc_id neither comes earlier; rows without
a doc_id come after all others, none of them before another (as if they had
the greatest id); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import bitmap, table
from .phrases import parse_texts

LENGTH = 100
#: Phrases of one trigger that a suffix array takes.
PART = 4000
#: Bytes of phrases in one Spark group.
PACK_BYTES = 1 << 20
#: Bytes of texts whose phrases a task holds at a time (a longer text alone).
SLICE_BYTES = 4 << 20


#: Order value of the rows without a doc_id.
LAST = (1 << 63) - 1


def _name(doc_id: Column) -> Column:
    """A hash of the text that tells rows of the same doc_id apart: 32 bits, as
    it travels with every phrase; 64 for the many rows that may have no doc_id."""
    return F.when(doc_id.isNull(), F.xxhash64("text")).otherwise(F.hash("text").cast("long").bitwiseAND(0xFFFFFFFF))


def _docs(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(LAST)).alias("doc_id"), _name(doc_id).alias("__t"), "text")


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Cuts batches into runs of rows of about SLICE_BYTES, with their texts in UTF-8."""
    for b in batches:
        texts, size, lo = [], 0, 0
        for hi, text in enumerate(b["text"]):
            texts.append(text.encode() if text else b"")
            size += len(texts[-1])
            if size >= SLICE_BYTES or hi == len(b) - 1:
                yield b.iloc[lo:hi + 1], texts
                texts, size, lo = [], 0, hi + 1


def triggers(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(g): the trigger of every phrase of every text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in _slices(batches):
            for _, _, _, _, _, h in parse_texts(texts, length):
                yield pd.DataFrame({"g": h.view(np.int64)})
    return docs.select("text").mapInPandas(run, "g long")


def _phrases(docs: DataFrame, keep, length: int, with_bytes: bool) -> DataFrame:
    """Phrases whose trigger is in the bitmap: doc_id, __t, trigger g, hash u, and
    either the bytes and the first window a of the leftmost place in the
    document, or every place: the first window a, the number n of further ones
    and whether the document has the phrase further left (``again``), packed
    into one long (a: upper 32 bits, again: lowest bit)."""
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for b, texts in _slices(batches):
            parts = []
            for row, start, whole, f, la, h in parse_texts(texts, length):
                ok = np.flatnonzero(shared.value.test(h))
                strings = [whole[i:j] for i, j in zip(f[ok].tolist(), (la[ok] + length).tolist())]
                u = np.fromiter(map(xxhash.xxh3_64_intdigest, strings), np.uint64, len(ok))
                part = {"r": row[ok], "g": h[ok].view(np.int64), "u": u.view(np.int64), "a": start[ok], "n": (la - f)[ok]}
                parts.append(pd.DataFrame(part | ({"s": strings} if with_bytes else {})))
            if not parts:
                continue
            out = pd.concat(parts, ignore_index=True).sort_values(["r", "a"], kind="stable")
            again = out.duplicated(["r", "g", "u"])
            if with_bytes:
                out = out[~again].drop(columns="n")
            else:
                place = out.pop("a").to_numpy(np.int64) << 32 | out.pop("n").to_numpy(np.int64) << 1 | again.to_numpy(np.int64)
                out = out.assign(place=place)
            ids = b[["doc_id", "__t"]].iloc[out.pop("r")].reset_index(drop=True)
            yield pd.concat([ids, out.reset_index(drop=True)], axis=1)
    return docs.mapInPandas(run, "doc_id long, __t long, g long, u long, " + ("a int, s binary" if with_bytes else "place long"))


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at each position of ``data`` (uint8) among all of
    them, compared up to ``length`` bytes; equal ranks are equal strings.
    Prefix doubling from 8 bytes; positions near the end compare as if zero
    bytes followed."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    wide = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | wide[k:k + n]
    rank, size = np.unique(key, return_inverse=True)[1].astype(np.uint64), 8
    while size < length:
        step = min(size, length - size)
        later = np.concatenate([rank[step:], np.zeros(min(step, n), np.uint64)])
        rank = np.unique((rank << np.uint64(32)) | later, return_inverse=True)[1].astype(np.uint64)
        size += step
    return rank.astype(np.int64)


def _earlier(pdf: pd.DataFrame, length: int) -> np.ndarray:
    """For whole dictionary parts (columns s, first, t, a): True for each window
    (in order of rows and starts) that another row holds at an earlier place."""
    strings = pdf["s"].tolist()
    sizes = np.array([len(s) for s in strings])
    rank = suffix_ranks(np.frombuffer(b"".join(strings), np.uint8), length)
    count = sizes - length + 1
    row = np.repeat(np.arange(len(strings)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    rank = rank[(np.cumsum(sizes) - sizes)[row] + at]
    doc, t, pos = pdf["first"].to_numpy()[row], pdf["t"].to_numpy()[row], pdf["a"].to_numpy()[row] + at
    order = np.lexsort((pos, t, doc, rank))
    rank, doc, t = rank[order], doc[order], t[order]
    head = np.ones(len(order), bool)
    head[1:] = rank[1:] != rank[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    same = np.zeros(len(order), bool)
    same[1:] = ~head[1:] & (doc[1:] == doc[:-1]) & (t[1:] == t[:-1])
    out = np.empty(len(order), bool)
    out[order] = (doc != doc[lead]) | same
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def _contested(docs: DataFrame, entries: DataFrame, length: int, part: int) -> DataFrame:
    """(g, u, first, t, windows): for the first place of each phrase of a contested
    trigger, the ranges of its windows that stand earlier elsewhere.
    ``entries``: g, u, first of every dictionary phrase."""
    per = entries.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    many = stage(entries.join(per, "g"), "phrases-contested")
    ids = many.select(F.xxhash64("first").alias("k"))
    in_firsts = docs.sparkSession.sparkContext.broadcast(bitmap(ids, "k"))

    def firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[in_firsts.value.test(b.pop("k").to_numpy().view(np.uint64))]
    held = docs.withColumn("k", F.xxhash64("doc_id")).mapInPandas(firsts, "doc_id long, __t long, text string")
    found = _phrases(held, bitmap(many, "g"), length, True)
    entry = found.select("g", "u", "a", "s", F.col("doc_id").alias("first"), F.col("__t").alias("t")).join(many, ["g", "u", "first"])
    entry = stage(entry, "phrases-bytes")

    packs = max(1, (entry.agg(F.sum(F.length("s"))).first()[0] or 0) // PACK_BYTES)

    def arrays(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["g", "u", "first", "t"])   # rows repeated in the table
        flags, at, windows = _earlier(pdf, length), 0, []
        for s in pdf["s"]:
            windows.append([{"lo": i, "hi": j} for i, j in _runs(flags[at:at + len(s) - length + 1])])
            at += len(s) - length + 1
        return pdf[["g", "u", "first", "t"]].assign(windows=windows)
    kind = "array<struct<lo:int,hi:int>>"
    small = entry.where(F.col("m") <= part).withColumn("p", F.pmod("g", F.lit(packs))) \
        .groupBy("p").applyInPandas(arrays, f"g long, u long, first long, t long, windows {kind}")

    each = entry.where(F.col("m") > part).select("g", "u", "a", "first", "t", "s", F.explode(F.sequence(F.lit(0), F.length("s") - length)).alias("o"))
    each = each.withColumn("w", F.xxhash64(F.expr(f"substring(s, o + 1, {length})"))).drop("s")
    own = each.groupBy("g", "w", "first", "t").agg(F.min(F.col("a") + F.col("o")).alias("p"))
    lead = own.groupBy("g", "w").agg(F.min("first").alias("d"))
    late = each.join(own, ["g", "w", "first", "t"]).join(lead, ["g", "w"]) \
        .where((F.col("first") != F.col("d")) | (F.col("a") + F.col("o") != F.col("p")))
    large = late.groupBy("g", "u", "first", "t").agg(F.transform(F.collect_set("o"), lambda o: F.struct(o.alias("lo"), o.alias("hi"))).alias("windows"))
    return small.unionByName(large.withColumn("windows", F.col("windows").cast(kind)))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, part: int = PART) -> DataFrame:
    """(doc_id, __t, lo, hi): windows lo..hi of a document (byte offsets of
    their starts) whose strings start earlier; doc_id is LAST for rows without."""
    docs = _docs(docs)
    often = triggers(docs, length).groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = stage(_phrases(docs, bitmap(often, "g"), length, False), "phrases")
    entries = stage(places.groupBy("g", "u").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("places")), "phrases-dictionary")
    windows = stage(_contested(docs, entries.select("g", "u", "first"), length, part).where(F.size("windows") > 0), "phrases-windows")
    known = entries.join(windows, ["g", "u", "first"], "left").where((F.col("places") > 1) | F.col("windows").isNotNull()).drop("places")
    judged = places.join(known, ["g", "u"])
    a, n, again = (F.expr(x) for x in ("CAST(shiftright(place, 32) AS INT)", "CAST(shiftright(place & 4294967295, 1) AS INT)", "place & 1 = 1"))
    whole = F.array(F.struct(F.lit(0).alias("lo"), n.alias("hi")))
    ranges = F.when(again | (F.col("first") < F.col("doc_id")), whole).when(F.col("__t") == F.col("t"), F.col("windows"))
    return judged.select("doc_id", "__t", a.alias("a"), F.explode(ranges).alias("w")) \
        .select("doc_id", "__t", (F.col("a") + F.col("w.lo")).alias("lo"), (F.col("a") + F.col("w.hi")).alias("hi"))


def cut(text: bytes, ranges, length: int = LENGTH) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs (start, end) and the remaining bytes."""
    runs: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        end = hi + length
        if runs and lo <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((lo, end))
    kept, at = [], 0
    for lo, end in runs:
        kept.append(text[at:lo])
        at = end
    return runs, b"".join([*kept, text[at:]])


def substring_dedup(docs: DataFrame, length: int = LENGTH, part: int = PART) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) of every row: the removed runs (start
    and end in bytes) and the remaining bytes."""
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(LAST)).alias("__k"),
                       _name(doc_id).alias("__t"), "text")
    lists = repeated_ranges(docs, length, part).groupBy(F.col("doc_id").alias("__d"), F.col("__t").alias("__u")) \
        .agg(F.collect_set(F.shiftleft(F.col("lo").cast("long"), 32).bitwiseOR(F.col("hi").cast("long"))).alias("w"))   # one long each
    both = rows.join(lists, (rows["__k"] == F.col("__d")) & (rows["__t"] == F.col("__u")), "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t.encode() if t else b"" for t in b["text"]]
            done = [cut(t, [(x >> 32, x & 0xFFFFFFFF) for x in w.tolist()] if w is not None else [], length) for t, w in zip(texts, b["w"])]
            yield pd.DataFrame({"doc_id": b["doc_id"], "none": b["none"], "n_bytes": [len(t) for t in texts],
                                "removed": [[{"start": i, "end": j} for i, j in r] for r, _ in done], "kept": [k for _, k in done]})
    out = both.select("doc_id", "none", "text", "w").mapInPandas(
        run, "doc_id long, none boolean, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")
    return out.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "n_bytes", "removed", "kept")


def op7_substrings(spark, sf_dir):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))
