"""Substring dedup by paragraphs.

Method: paragraph MinHash banding, bands tuned for high recall; colliding
paragraphs join, exact Jaccard similarity verifies them, and the removals
follow the connected components.

A paragraph is a line.  Its words are A-Z lower-cased runs of anything but
ASCII white space, its shingles five neighbouring words; paragraphs of fewer
words take no part.  Two paragraphs link at a Jaccard similarity of 0.8 or
more of their shingle sets.  Of each class (connected component) the first
paragraph (smallest doc_id, then line number) stays.

Passages that repeat inside lines, whatever stands around them, are found by
pieces: every line is cut where a shingle's hash is the least of the ``REACH``
shingles on either side (in wide gaps: of half as many), so that equal passages
get equal cuts wherever they stand, and after ``PIECE`` words at the latest.
Equal pieces form a class, whose first place (doc_id, line, word) stays.  The
others go if they hold together: neighbouring pieces that are also neighbours
at the first place make up a run, and a run of at least ``RUN`` words is a
repeated passage; shorter ones stay.  Lines that go as a whole take no part in
it, and lines of fewer than ``RUN`` words have no such passage.

``tune`` picks bands and rows such that a pair at the threshold is missed with
a probability of at most 1 in 1,000; more similar pairs are missed less, and a
class stays whole as long as some chain of its links is found.  Paragraphs
with equal words collapse first, so copies cost one key each.  Paragraphs that
collide in any band meet under the least of the band's paragraphs; such a
group is dealt into tile pairs of bounded size (tiles.py), each of which
verifies exactly and returns spanning links only.

Defined cases: null and empty texts have no paragraphs; rows that repeat a
doc_id with the same text count once, with another text by their hash; rows
without doc_id come after all others and are told apart by their text; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import stage
from .common import ascii_words, bitmap, mix64, table
from .tiles import Links, tile_pairs

SHINGLE, SIMILARITY, MISSED = 5, 0.8, 1e-3
#: Paragraphs hashed at a time.
PARAGRAPHS = 4096
#: Least words of a repeated run inside lines; reach of a cut, and most words of a piece.
RUN, REACH, PIECE = 16, 8, 64
#: Order value of the rows without a doc_id.
LAST = (1 << 63) - 1


def tune(similarity: float = SIMILARITY, missed: float = MISSED, rows: int = 2) -> tuple[int, int]:
    """(bands, rows): the fewest bands that miss a pair at ``similarity`` with
    at most the given probability, (1 - s**rows)**bands."""
    return int(np.ceil(np.log(missed) / np.log(1 - similarity ** rows))), rows


def shingle_hashes(words: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the n-word shingles."""
    from zlib import crc32
    w = mix64(np.fromiter(map(crc32, words), np.uint64, len(words)) | np.fromiter(map(len, words), np.uint64, len(words)) << np.uint64(32))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ w[k:len(words) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(mix64(h))


def batch_shingles(paras: list[list[bytes]], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of paragraphs of n words or more, in order
    and hashed together, and the number of each paragraph's."""
    from zlib import crc32
    counts = np.array([len(w) for w in paras])
    flat = [x for w in paras for x in w]
    w = mix64(np.fromiter(map(crc32, flat), np.uint64, len(flat)) | np.fromiter(map(len, flat), np.uint64, len(flat)) << np.uint64(32))
    h = np.zeros(len(flat) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ w[k:len(flat) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
    inside = np.arange(len(h)) + n <= np.repeat(np.cumsum(counts), counts)[:len(h)]
    return mix64(h[inside]), counts - n + 1


def band_keys(paras: list[list[bytes]], bands: int, rows: int, n: int = SHINGLE) -> np.ndarray:
    """MinHash band keys of paragraphs of n words or more, a row for each."""
    return _band_keys(*batch_shingles(paras, n), bands, rows)


def _band_keys(h: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    seeds = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(counts), 1))
    for i, s in enumerate(seeds):
        least = np.minimum.reduceat((h ^ s) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(7), starts)
        out[:, i // rows] = mix64(out[:, i // rows] * np.uint64(0x9E3779B97F4A7C15) ^ least)
    return out


def cuts(h: np.ndarray, counts: np.ndarray, reach: int = REACH) -> list[np.ndarray]:
    """Per paragraph, the words before which it is cut: those whose shingle has
    the least hash of ``reach`` neighbours on either side (the first of equal
    ones), all of them inside the paragraph; and, farther than ``reach`` from
    all of these, those that have the least of half as many."""
    ends = np.cumsum(counts)
    at = np.arange(len(h)) - np.repeat(ends - counts, counts)
    after = np.repeat(counts, counts) - 1 - at

    def least(r: int) -> np.ndarray:
        out = (at >= r) & (after >= r)
        for k in range(1, min(r, len(h) - 1) + 1):
            out[k:] &= h[k:] < h[:-k]
            out[:-k] &= h[:-k] <= h[k:]
        return out
    far, wide = least(reach), least(reach // 2)
    total = np.concatenate([[0], np.cumsum(far)])
    k = np.arange(len(h))
    near = total[np.minimum(k + reach + 1, len(h))] - total[np.maximum(k - reach, 0)] > 0
    places = np.flatnonzero(far | (wide & ~near & (at >= 2 * reach) & (after >= 2 * reach)))
    return [at[x] for x in np.split(places, np.searchsorted(places, ends[:-1]))]


def pieces(words: list[bytes], cut: np.ndarray, shortest: int, longest: int = PIECE) -> list[tuple[int, int]]:
    """(start, words) of the pieces of a paragraph of ``shortest`` words or more."""
    edges = [0, *cut.tolist(), len(words)]
    parts = [(k, min(longest, b - k)) for a, b in zip(edges, edges[1:]) for k in range(a, b, longest)]
    return [x for x in parts if x[1] >= shortest]


def paragraphs(docs: DataFrame, bands: int, rows: int, shingle: int = SHINGLE, run_words: int = RUN) -> DataFrame:
    """(doc_id, __t, line, p, words, bands, pieces): paragraphs with their
    name ``p`` (128-bit hash of the words), band keys and named pieces (of
    those of ``run_words`` words or more); doc_id is LAST where there is none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for b in batches:
            at, words = [], []
            for d, t, text in zip(b["doc_id"], b["__t"], b["text"]):
                for n, line in enumerate(text.split("\n") if text else ()):
                    if len(w := ascii_words(line)) >= shingle:
                        at.append((d, t, n))
                        words.append(w)
            for i in range(0, len(at), PARAGRAPHS):
                part = words[i:i + PARAGRAPHS]
                whole = [b" ".join(w) for w in part]
                h, counts = batch_shingles(part, shingle)
                keys = _band_keys(h, counts, bands, rows).view(np.int64)
                inner = [[{"word": k, "n": n, "q": xxhash.xxh3_128_digest(b" ".join(w[k:k + n]))} for k, n in pieces(w, c, shingle)]
                         if len(w) >= run_words else [] for w, c in zip(part, cuts(h, counts))]
                yield pd.DataFrame(at[i:i + PARAGRAPHS], columns=["doc_id", "__t", "line"]).assign(
                    p=[xxhash.xxh3_128_digest(x) for x in whole], words=whole, bands=list(keys), pieces=inner)
    rows_ = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("__t"), "text")
    return rows_.mapInPandas(run, "doc_id long, __t long, line int, p binary, words binary, bands array<long>, "
                                  "pieces array<struct<word:int,n:int,q:binary>>")


def similar(a: list[np.ndarray], b: list[np.ndarray] | None, links: Links, similarity: float = SIMILARITY) -> None:
    """Adds the links of all pairs with Jaccard similarity of ``similarity`` or
    more within ``a``, or between ``a`` and ``b`` (numbered after ``a``).  Pairs share one of their rarest shingles (prefix filter: of a
    set of n, at most n - ceil(s n) may be missing); pairs that are joined
    already are skipped."""
    sets = a + (b or [])
    every, counts = np.unique(np.concatenate(sets), return_counts=True)
    index: dict[int, list[int]] = {}
    side = [False] * len(a) + [True] * len(b or [])
    for i, h in enumerate(sets):
        rare = h[np.argsort(counts[np.searchsorted(every, h)], kind="stable")]
        prefix = rare[:len(h) - int(np.ceil(similarity * len(h) - 1e-9)) + 1].tolist()
        seen = {j for x in prefix for j in index.get(x, ())}
        for j in sorted(seen):
            if (b is not None and side[i] == side[j]) or links.of[i] == links.of[j]:
                continue
            o = sets[j]
            if min(len(h), len(o)) < similarity * max(len(h), len(o)):
                continue
            both = len(np.intersect1d(h, o, assume_unique=True))
            if both >= similarity * (len(h) + len(o) - both) - 1e-9:
                links.add(np.array([i]), np.array([j]))
        for x in prefix:
            index.setdefault(x, []).append(i)


def verified_links(paras: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Spanning links (a, b) of distinct paragraphs, from their places (p,
    words, bands).  Only paragraphs that collide bring their words along."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, unit in pdf.groupby("__u", sort=False):
            unit = unit.sort_values("__side", kind="stable")
            names, n = unit["p"].tolist(), int((unit["__side"] == 0).sum())
            sets = [shingle_hashes(w.split(), shingle) for w in unit["words"]]
            found = Links(len(sets))
            similar(sets[:n], sets[n:] if n < len(sets) else None, found, similarity)
            a, b = found.joined()
            out.append(pd.DataFrame({"a": [names[i] for i in a], "b": [names[i] for i in b]}))
        return pd.concat(out)
    distinct = stage(paras.groupBy("p").agg(F.first("bands").alias("bands")), "paras-distinct")
    keyed = distinct.select("p", F.explode("bands").alias("k"))
    least = keyed.groupBy("k").agg(F.min(F.xxhash64("p")).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(keyed.join(least, "k").select("lead", "p").distinct(), "para-members")
    colliding = paras.sparkSession.sparkContext.broadcast(bitmap(members.select(F.xxhash64("p").alias("h")), "h"))

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[colliding.value.test(b.pop("h").to_numpy().view(np.uint64))]
    texts = paras.select("p", "words", F.xxhash64("p").alias("h")).mapInPandas(held, "p binary, words binary") \
        .groupBy("p").agg(F.first("words").alias("words"))
    units = tile_pairs(members, "lead", F.col("p"), tile=512, pack=8192)
    return units.join(texts, "p").groupBy("__pack").applyInPandas(run, "a binary, b binary").distinct()


def piece_classes(paras: DataFrame, gone: DataFrame, run_words: int = RUN) -> DataFrame:
    """(doc_id, __t, line, class_doc_id, class_line, removed, word, n_words,
    class_word) of the pieces in runs of ``run_words`` or more that occur again,
    and of their first places, in ``paras`` without the lines ``gone`` (doc_id,
    __t, line)."""
    every = paras.select("doc_id", "__t", "line", F.inline("pieces"))
    often = every.groupBy("q").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.xxhash64("q").alias("h"))
    repeated = paras.sparkSession.sparkContext.broadcast(bitmap(often, "h"))

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[repeated.value.test(b.pop("h").to_numpy().view(np.uint64))]
    some = every.withColumn("h", F.xxhash64("q")).mapInPandas(held, every.schema)
    kept = stage(some.join(gone, ["doc_id", "__t", "line"], "left_anti").distinct(), "pieces-held")
    place = F.struct("doc_id", "line", "word", "__t")
    least = kept.groupBy("q").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    later = kept.join(least, "q").where(place != F.col("f"))
    # a run: pieces that follow each other here and at the first places; a window spans one line
    line = Window.partitionBy("doc_id", "__t", "line").orderBy("word")
    before = F.lag(F.struct((F.col("word") + F.col("n")).alias("word"), F.col("f.doc_id").alias("d"), F.col("f.line").alias("l"), F.col("f.__t").alias("t"),
                            (F.col("f.word") + F.col("n")).alias("w"))).over(line)
    here = F.struct("word", F.col("f.doc_id").alias("d"), F.col("f.line").alias("l"), F.col("f.__t").alias("t"), F.col("f.word").alias("w"))
    runs = later.withColumn("new", F.coalesce(before != here, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(line))
    whole = Window.partitionBy("doc_id", "__t", "line", "run")
    runs = stage(runs.withColumn("size", F.sum("n").over(whole)).where(F.col("size") >= run_words).drop("new", "run", "size"), "pieces-runs")
    firsts = least.join(runs.select("q").distinct(), "q").join(kept.select("q", "n").distinct(), "q")
    firsts = firsts.select("q", F.col("f.doc_id").alias("doc_id"), F.col("f.__t").alias("__t"), F.col("f.line").alias("line"), F.col("f.word").alias("word"), "n", "f")
    both = runs.withColumn("removed", F.lit(True)).unionByName(firsts.withColumn("removed", F.lit(False)))
    return both.select("doc_id", "__t", "line", F.col("f.doc_id").alias("class_doc_id"), F.col("f.line").alias("class_line"), "removed", "word",
                       F.col("n").alias("n_words"), F.col("f.word").alias("class_word"))


def paragraph_classes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, run_words: int = RUN) -> DataFrame:
    """(doc_id, __t, line, class_doc_id, class_line, removed, word, n_words,
    class_word) of every paragraph in a class of two places or more and of every
    piece of a repeated run; the last three are null for whole lines."""
    paras = stage(paragraphs(docs, *tune(similarity), shingle, run_words), "paras")
    parts = stage(connected_components(verified_links(paras, shingle, similarity), "a", "b"), "paras-classes")
    places = paras.select("doc_id", "__t", "line", "p").distinct()
    named = places.join(parts, places["p"] == parts["id"], "left").select("doc_id", "__t", "line", F.coalesce("component", "p").alias("c"))
    named = stage(named, "paras-named")
    least = named.groupBy("c").agg(F.min(F.struct("doc_id", "line", "__t")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = F.struct("doc_id", "line", "__t") == F.col("f")
    null = F.lit(None).cast("int")
    whole = stage(named.join(least, "c").select(
        "doc_id", "__t", "line", F.col("f.doc_id").alias("class_doc_id"), F.col("f.line").alias("class_line"), (~same).alias("removed"),
        null.alias("word"), null.alias("n_words"), null.alias("class_word")), "paras-whole")
    every = whole.unionByName(piece_classes(paras, whole.where("removed").select("doc_id", "__t", "line"), run_words))
    return every.withColumns({c: F.when(F.col(c) != LAST, F.col(c)) for c in ("doc_id", "class_doc_id")})


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def without(text: str, gone) -> str:
    """``text`` without the places ``gone`` (line, word, n_words; a null word:
    the whole line).  A piece goes up to the next word."""
    places: dict[int, list] = {}
    for x in gone:
        places.setdefault(x["line"], []).append((x["word"], x["n_words"]))
    out = []
    for k, line in enumerate(text.split("\n")):
        if k in places:
            if any(w is None for w, _ in places[k]):
                continue
            raw = line.encode()
            at = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
            for w, n in sorted(places[k], reverse=True):
                raw = raw[:at[w]] + raw[at[w + n]:]
            line = raw.decode()
        out.append(line)
    return "\n".join(out)


def passage_dedup(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, run_words: int = RUN) -> DataFrame:
    """``docs`` with repeated paragraphs and pieces removed from ``text``."""
    def kept(text: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([t if g is None else without(t, g) for t, g in zip(text, gone)], dtype=object)
    kept = F.pandas_udf(kept, "string")
    gone = paragraph_classes(docs, shingle, similarity, run_words).where("removed").groupBy(F.col("doc_id").alias("__d"), F.col("__t").alias("__u")) \
        .agg(F.collect_set(F.struct("line", "word", "n_words")).alias("__gone"))
    keyed = docs.withColumn("__t", F.xxhash64("text"))
    both = keyed.join(gone, keyed["doc_id"].eqNullSafe(F.col("__d")) & (F.col("__t") == F.col("__u")), "left")
    return both.select(*[kept("text", "__gone").alias("text") if c == "text" else F.col(c) for c in docs.columns])


def op10_passages(spark, sf_dir):
    """doc_id, line, class_doc_id, class_line, removed of every paragraph that
    occurs again, equal or nearly so, and of every piece of a run that is
    repeated inside lines, with its place in the line: word, n_words, class_word."""
    out = paragraph_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line", "class_doc_id", "class_line", "removed", "word", "n_words", "class_word")
