"""Similarity of texts and of vectors: groups of texts whose word shingles
agree (V6 / J10), and pairs of vectors from a cosine threshold on (V4).

``similar_groups`` is an exact Jaccard join that ends in connected components:

1. A text is the set of its word shingles (64-bit hashes).  Texts with equal
   sets are one class, so copies take part once.
2. Shingles have one order: those of one class only come first, then those of
   several, then common ones (those that several texts of a bounded sample
   share; the sample only shapes the order), else by hash.  Two sets of
   similarity t share a shingle among the first ``n - ceil(t n) + 1`` of each,
   in whatever order (prefix filter).  Shingles of several classes are known by
   a bitmap, which may take others for such, never the reverse: the order is
   one for all sets.  Own shingles fill the prefix of most texts, which end
   here, however many texts there are; later rounds read the others' sets only.
3. Classes that share a prefix shingle are compared under the length bound and
   the bound on the overlap that the shingle's places leave; exact set
   intersection decides.  No group emits all its pairs: in each round the
   first classes of every shingle ("leaders") meet the others, then leave the
   shingle; a shingle whose classes are in one component already is done.  A
   large group of near copies falls together in the first rounds; the number
   of leaders grows fourfold from round to round, so groups of unlike texts end
   after logarithmically many rounds.  Every pair that shares a prefix shingle
   is compared or lies in one component, so no link between components is
   lost.

Leaders come from a ranked window that Spark cuts to their number before the
shuffle, the other side of that join is split by AQE where a shingle is hot.

``cosine_links`` joins unit vectors from a threshold on: pivots deal them into
balls; two blocks of vectors meet only if the angle between their centres less
their radii leaves room for the threshold, and this is decided on one row for
each block before any vector moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, unstage
from .components import connected_components

SHINGLE, THRESHOLD = 5, 0.8
#: Leaders of a shingle in the first round, and their growth.
LEADERS, GROWTH = 1, 4
#: Texts of the sample, how many of them share a common shingle, and how many common shingles there are at most.
TEXTS, SHARED, COMMON = 1 << 14, 4, 1 << 17
#: Bits of the bitmap at least and at most, and bytes of an Arrow batch.
BITS, MOST_BITS, BATCH = 26, 29, 8 << 20
#: Bits by which shingles are counted (whole bytes), shingles that a task sends at a time, and that a partition counts.
WIDE, RUN, PART = 40, 1 << 22, 1 << 21
#: Bytes of texts that are hashed at a time.
PIECE = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers."""
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


#: ASCII white space; bytes with A-Z lower-cased, each as a number of 64 bits; bytes of a word that are hashed here, and the multipliers of their places.
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LETTERS = _mix(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
WORD = 48
PLACES = _odd(WORD, 3)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of UTF-8 bytes, in order; A-Z count as
    lower case, a word is a run of anything but ASCII white space."""
    import xxhash
    edge = np.diff(np.concatenate([[True], WHITE[data], [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = ends - starts
    out = _mix(size.astype(np.uint64))
    short = np.minimum(size, WORD)
    place = np.arange(int(short.sum())) - np.repeat(np.cumsum(short) - short, short)
    if len(place):
        out += np.add.reduceat(LETTERS[data[np.repeat(starts, short) + place]] * PLACES[place], np.cumsum(short) - short)
    for k in np.flatnonzero(size > WORD):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]].tobytes().lower())
    return _mix(out), starts


def shingles_of(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct hashes (as signed longs) of the runs of
    ``size`` words (fewer words: of the whole sequence; none: empty)."""
    h, starts = word_hashes(np.frombuffer(b" ".join(texts), np.uint8))
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    by = _odd(size, 1)
    runs = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        runs += h[k:len(runs) + k] * by[k]
    runs, out, lo = _mix(runs).view(np.int64), [], 0
    for hi in ends.tolist():
        if hi - lo >= size:
            v = np.sort(runs[lo:hi - size + 1])
            out.append(v[np.concatenate([[True], v[1:] != v[:-1]])])
        else:
            few = h[lo:hi]
            out.append(_mix((few * by[:len(few)]).sum(keepdims=True, dtype=np.uint64) + _odd(size, 2)[len(few):len(few) + 1]).view(np.int64)[:len(few)])
        lo = hi
    return out


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The shingles of one text."""
    return shingles_of([(text or "").encode()], size)[0]


def shingle_sets(df: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(id, c, n, sh): the shingle set of every text, its size and its name c (a
    128-bit hash in hex; null for the empty set).  Texts are read as bytes, some
    PIECE of them at a time."""
    kind = df.schema[id_col].dataType.simpleString()

    def pieces(texts: pa.Array) -> Iterator[list[bytes]]:
        held, n = [], 0
        for t in texts.cast(pa.binary()).to_pylist():
            held.append(t or b"")
            n += len(held[-1])
            if n >= PIECE:
                yield held
                held, n = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            at = 0
            for texts in pieces(b.column("text")):
                sets = shingles_of(texts, size)
                n = np.array([len(x) for x in sets], np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate(sets)))
                c = [xxhash.xxh3_128_hexdigest(x.tobytes()) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, len(texts)), pa.array(c, pa.string()), pa.array(n), flat], ["id", "c", "n", "sh"])
                at += len(texts)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    return rows.mapInArrow(run, f"id {kind}, c string, n long, sh array<long>")


def _sample(classes: DataFrame, texts: int) -> DataFrame:
    """The classes of the least names, about TEXTS of ``texts``."""
    bound = int(min(1.0, TEXTS / max(1, texts)) * 0xFFFFFFFF)
    return classes.where(F.col("c") <= f"{bound:08x}" + "f" * 24)


def _common(sample: DataFrame) -> np.ndarray:
    """The most common shingles of a sample of the classes (at most COMMON, sorted)."""
    often = sample.select(F.explode("sh").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= SHARED)
    return np.sort(np.array([r["s"] for r in often.orderBy(F.col("f").desc(), "s").limit(COMMON).collect()], np.int64))


def _bitmap(values: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for each value of column ``s`` (modulo 2**bits): at most one row of
    4 KB for each 32,768 bits reaches the driver."""
    at = values.select(F.col("s").bitwiseAND((1 << bits) - 1).alias("at"))
    rows = at.groupBy(F.expr("bitmap_bucket_number(at + 1)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1))").alias("m"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.collect():
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def _set(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _twice(classes: DataFrame, total: int | None = None) -> DataFrame:
    """(s): the low WIDE bits of the shingles that two classes or more hold (two
    shingles that agree in them count as one).  Tasks send sorted runs of
    them, a few large rows with at most two of a value, in place of a row for
    each shingle; a partition then sorts the runs of its ranges, PART values
    or so, so no task holds more, however many there are (``total`` of all
    classes, where the caller knows it)."""
    total = classes.agg(F.sum("n")).first()[0] if total is None else total
    parts = max(1, -(-(total or 0) // PART))
    edges = np.array([(k << WIDE) // (4 * parts) for k in range(4 * parts + 1)], np.int64)

    def runs(held: list[np.ndarray]) -> pa.RecordBatch:
        v = np.sort(np.concatenate(held) & ((1 << WIDE) - 1))
        more = np.ones(len(v), bool)
        more[2:] = v[2:] != v[:-2]
        v = v[more]
        at = np.searchsorted(v, edges)
        low = v.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :WIDE // 8]
        full = np.flatnonzero(at[1:] > at[:-1])
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([low[at[k]:at[k + 1]].tobytes() for k in full], pa.binary())], ["part", "v"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).flatten().to_numpy())
            n += len(held[-1])
            if n >= RUN:
                yield runs(held)
                held, n = [], 0
        if n:
            yield runs(held)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.frombuffer(b"".join(x for b in batches for x in b.column("v").to_pylist()), np.uint8).reshape(-1, WIDE // 8)
        v = np.zeros((len(low), 8), np.uint8)
        v[:, :WIDE // 8] = low
        v = np.sort(v.view("<i8").ravel())
        v = v[1:][v[1:] == v[:-1]]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(v), pa.int64())], ["s"])
    return classes.select("sh").mapInArrow(sent, "part long, v binary").repartition(parts, "part").mapInArrow(met, "s long")


def _placed(classes: DataFrame, num: int, den: int, sample: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """(c, n, sh, own, lead): the classes whose own shingles do not fill their
    prefix, with their number ``own`` and the shared ones that fill the rest, in
    the class's order.  Every shingle of every class is counted, once, so a
    class gives away a shared shingle only where its own ones do not do."""
    spark = classes.sparkSession
    common = spark.sparkContext.broadcast(_common(_sample(classes, classes.count()) if sample is None else sample))
    twice = stage(_twice(classes, total), "similar-twice")
    bits = min(max(BITS, (8 * twice.count()).bit_length()), MOST_BITS)
    shared = spark.sparkContext.broadcast(_bitmap(twice, bits))
    unstage(twice)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, late = shared.value, common.value
        for b in batches:
            sets, n = b.column("sh"), b.column("n").to_numpy()
            flat = sets.flatten().to_numpy()
            several = _set(seen, flat & ((1 << bits) - 1))
            ends = np.cumsum(n)
            upto = np.concatenate([[0], np.cumsum(several)])
            own = n - (upto[ends] - upto[ends - n])
            rest = n + n * -num // den + 1 - own
            open_ = np.flatnonzero(rest > 0)
            lead = []
            for k in open_:
                held = flat[ends[k] - n[k]:ends[k]][several[ends[k] - n[k]:ends[k]]]
                near = np.minimum(np.searchsorted(late, held), max(len(late) - 1, 0))
                known = late[near] == held if len(late) else np.zeros(len(held), bool)
                lead.append(np.concatenate([held[~known], held[known]])[:rest[k]])
            kept = b.take(pa.array(open_))
            yield pa.RecordBatch.from_arrays([kept.column("c"), kept.column("n"), kept.column("sh"), pa.array(own[open_], pa.int64()), pa.array(lead, pa.list_(pa.int64()))],
                                             ["c", "n", "sh", "own", "lead"])
    return classes.where("n > 0").select("c", "n", "sh").mapInArrow(placed, "c string, n long, sh array<long>, own long, lead array<long>")


def _leads(placed: DataFrame) -> DataFrame:
    """(s, c, n, pos): the shared prefix shingles of each class with their places (from 1) in the class's order."""
    rows = placed.select("c", "n", "own", F.posexplode("lead").alias("at", "s"))
    return rows.select("s", "c", "n", (F.col("own") + 1 + F.col("at")).alias("pos")).dropDuplicates(["s", "c"])


def _prefixes(classes: DataFrame, num: int, den: int) -> DataFrame:
    """(s, c, n, pos): the prefix shingles of each class that two classes or
    more hold, with their places (from 1) in the class's order."""
    return _leads(_placed(classes, num, den))


def held(rows: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """``rows`` without those whose ``key`` is surely not among ``values`` (one
    column): judged by a bitmap where the rows are, so what goes never moves."""
    return _marked(rows, key, _marks(values))


def _marks(values: DataFrame):
    return values.sparkSession.sparkContext.broadcast(_bitmap(values.select(F.xxhash64(values.columns[0]).alias("s"))))


def _marked(rows: DataFrame, key: str, bits) -> DataFrame:
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(len(names)).to_numpy() & ((1 << BITS) - 1)
            yield b.select(names).filter(pa.array(_set(bits.value, at)))
    return rows.withColumn("__h", F.xxhash64(key)).mapInArrow(run, rows.schema)


def _similar(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets have similarity num / den or more; ``classes``
    holds each class once.  Only sets of a pair move on; ``a`` are leaders, so
    theirs are few."""
    def sets(x: str) -> DataFrame:
        ids = pairs.select(x).distinct()
        return classes.join(ids.withColumnRenamed(x, "c"), "c", "left_semi").select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("sh").alias(f"s{x}"))
    both = pairs.join(sets("b"), "b").join(stage(sets("a"), "similar-heads"), "a")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return both.where(shared * (num + den) >= (F.col("na") + F.col("nb")) * num).select("a", "b")


def class_links(classes: DataFrame, threshold: float = THRESHOLD, sample: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """(id, component) of the classes (c, n, sh) that a chain of similar pairs
    links to another; component = the smallest c.  ``sample``: some of the
    classes, ``total``: their shingles in all, where the caller has them
    without a pass over all."""
    part = Fraction(str(threshold))
    num, den = part.numerator, part.denominator
    if not 0 < num <= den:
        raise ValueError("threshold must be above 0 and at most 1")
    placed, near = stage(_placed(classes, num, den, sample, total), "similar-placed"), None
    live = stage(_leads(placed), "similar-prefixes")
    known = placed.select(F.col("c").alias("id"), F.col("c").alias("component")).where("false")
    leaders = LEADERS
    least = F.expr(f"((nl + nm) * {num} + {num + den - 1}) div {num + den}")           # shared shingles that similarity asks for
    while True:
        named = live.join(known, live["c"] == known["id"], "left").select("s", "c", "n", "pos", F.coalesce("component", "c").alias("k"))
        open_ = named.groupBy("s").agg(F.min("k").alias("__a"), F.max("k").alias("__b")).where("__a < __b").select("s")
        left = stage(named.join(open_, "s", "left_semi"), "similar-open")
        unstage(live)
        if left.isEmpty():
            for old in (left, placed if near is None else near):
                unstage(old)
            return known
        if near is None:                                                               # only sets that share a prefix shingle are read from here on
            near = stage(held(placed.select("c", "n", "sh"), "c", left.select("c").distinct()).dropDuplicates(["c"]), "similar-near")
            unstage(placed)
        first = left.withColumn("__r", F.row_number().over(Window.partitionBy("s").orderBy("c"))).where(F.col("__r") <= leaders)
        first = stage(first.drop("__r"), "similar-leaders")
        heads = first.select("s", *[F.col(x).alias(f"{x}l") for x in ("c", "n", "pos", "k")])
        rest = left.select("s", *[F.col(x).alias(f"{x}m") for x in ("c", "n", "pos", "k")])
        meet = heads.join(rest, "s").where("cl < cm AND kl <> km").where(f"nl * {num} <= nm * {den} AND nm * {num} <= nl * {den}") \
            .where(F.least(F.col("nl") - F.col("posl"), F.col("nm") - F.col("posm")) + 1 >= least)
        pairs = stage(meet.select(F.col("cl").alias("a"), F.col("cm").alias("b")).distinct(), "similar-pairs")
        found = _similar(pairs, near, num, den).unionByName(known.select(F.col("id").alias("a"), F.col("component").alias("b")))
        before, known = known, stage(connected_components(found, "a", "b"), "similar-components")
        live = stage(left.join(first.select("s", "c"), ["s", "c"], "left_anti").select("s", "c", "n", "pos"), "similar-prefixes")
        for old in (left, first, pairs, before):
            unstage(old)
        leaders *= GROWTH


def similar_groups(df: DataFrame, id_col: str = "id", text_col: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(id, component, size) of every row: the smallest id that a chain of texts
    of similarity ``threshold`` or more (Jaccard of word shingles) leads to, and
    the rows of its component.  A text without words (null too) is linked to
    nothing; rows without id take no part; an id that repeats links its rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    docs = stage(shingle_sets(df, id_col, text_col, size), "similar-sets")
    # one text stands for its class: the others' sets never move
    first = stage(docs.where("c IS NOT NULL").groupBy("c").agg(F.min("id").alias("id"), F.max("n").alias("n")), "similar-first")
    rows, marks = docs.where("c IS NOT NULL").select("id", "c", "n", "sh"), _marks(first.select("id"))
    classes, total = first.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    sample = _marked(_sample(rows, classes), "id", marks).select("c", "sh")
    known = class_links(_marked(rows, "id", marks).select("c", "n", "sh"), threshold, sample, total)
    low = first.select("c", F.col("id").alias("first"))
    named = low.join(known, low["c"] == known["id"], "left").select("c", "first", F.coalesce("component", "c").alias("k"))
    label = named.join(named.groupBy("k").agg(F.min("first").alias("component")), "k").select(F.col("c").alias("__c"), "component")
    rows = docs.join(label, docs["c"] == F.col("__c"), "left").select("id", F.coalesce("component", "id").alias("component"))
    again = rows.groupBy("id").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    split = again.where("low < high").select(F.col("low").alias("a"), F.col("high").alias("b"))      # only where an id repeats
    joined = rows.select(F.col("id").alias("a"), F.col("component").alias("b"))
    if not split.isEmpty():
        merged = connected_components(joined, "a", "b")
        rows = rows.select("id").join(merged, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    return rows.join(rows.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").select("id", "component", "size")


# --------------------------------------------------------------------------
# V4: pairs of vectors from a cosine threshold on
# --------------------------------------------------------------------------
#: Vectors whose smallest hashes are the sample that pivots come from.
SAMPLE, PIVOTS = 4096, 64
#: Vectors of a block and of the tiles that it is compared in, and pairs whose cosine is taken at a time.
BLOCK, TILE, CHUNK = 4096, 1024, 1 << 16


def _pivots(units: DataFrame, pivots: int, sample: int) -> np.ndarray:
    """Farthest-first pivots from a bounded sample of the vectors.  They only
    shape the balls: results do not depend on them."""
    rows = units.select("v").orderBy(F.xxhash64("c"), "c").limit(sample).collect()
    if not rows:
        return np.zeros((0, 0))
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r["v"]), []).append(r["v"])
    points = np.array(max(by.values(), key=len))
    chosen, near = [0], points @ points[0]
    while len(chosen) < min(pivots, len(points)):
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        chosen.append(far)
        near = np.maximum(near, points @ points[far])
    return points[chosen]


def unit_classes(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): the class c of each row with a usable vector (finite, not
    zero), and each class's unit vector v with its number of rows.  Rows with
    the same vector are one class, named by its smallest id."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    rows = df.select(F.col(id_col).alias("id"), vec.alias("__v"), norm.alias("__n"))
    # a null or NaN component makes the norm null or NaN; an infinite one infinite
    rows = rows.where("id IS NOT NULL AND __n > 0 AND __n < double('Infinity')")
    rows = rows.select("id", F.col("__v").alias("raw"), "__n")
    first = rows.groupBy("raw").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("copies"), F.max("__n").alias("n"))
    held = stage(first, "cosine-classes")
    classes = held.select("c", "copies", F.expr("transform(raw, x -> x / n)").alias("v"))
    members = rows.select("id", "raw").join(held.select("raw", "c"), "raw").select("id", "c")
    return members, classes


def _dealt(classes: DataFrame, centers: np.ndarray) -> DataFrame:
    """Classes with their dimension, the pivot nearest to them (ball; 0 where no
    pivot has their dimension) and the angle to it."""
    shared = classes.sparkSession.sparkContext.broadcast(centers)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for b in batches:
            ball, angle = np.zeros(len(b), np.int32), np.full(len(b), np.pi)
            dim = b["v"].map(len).to_numpy(np.int32)
            fits = np.flatnonzero(dim == own.shape[1]) if own.size else []
            if len(fits):
                cosine = np.stack(b["v"].iloc[fits].tolist()) @ own.T
                ball[fits] = cosine.argmax(axis=1)
                angle[fits] = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
            yield b[["c", "v"]].assign(ball=ball, dim=dim, angle=angle)
    kind = classes.schema["c"].dataType.simpleString()
    return classes.select("c", "v").mapInPandas(nearest, f"c {kind}, v array<double>, ball int, dim int, angle double")


def _blocks(dealt: DataFrame, balls: DataFrame, block: int) -> DataFrame:
    """The vectors of each ball in blocks of about ``block``: (dim, ball, part,
    ids, points, center, radius), the radius an angle."""
    kind = dealt.schema["c"].dataType.simpleString()
    cut = dealt.join(balls.select("dim", "ball", F.ceil(F.col("n") / block).cast("long").alias("parts")), ["dim", "ball"])
    cut = cut.withColumn("part", F.pmod(F.xxhash64("c", F.lit("part")), F.col("parts"))).select("dim", "ball", "part", "c", "v")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")
        points = np.stack(pdf["v"].tolist())
        mean = points.mean(axis=0)
        norm = np.linalg.norm(mean)
        center = mean / norm if norm > 0 else points[0]
        radius = float(np.arccos(np.clip((points @ center).min(), -1, 1)))
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "ball": pdf["ball"].iloc[:1], "part": pdf["part"].iloc[:1], "ids": [pdf["c"].tolist()],
                             "points": [points.tobytes()], "center": [center.tolist()], "radius": [radius]})
    # dealt by part as well, so a hot ball is many groups
    return cut.repartition("dim", "ball", "part").groupBy("dim", "ball", "part").applyInPandas(
        pack, f"dim int, ball int, part long, ids array<{kind}>, points binary, center array<double>, radius double")


def _angle(a: str, b: str) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return F.acos(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0)))


def _sides(small: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    return tuple(small.select("dim", *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")


def cosine_links(df: DataFrame, threshold: float, id_col: str = "id", vec_col: str = "vector", pivots: int = PIVOTS, sample: int = SAMPLE,
                 block: int = BLOCK) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(pairs, members, report): the pairs (a, b, cosine), a < b, of classes of
    different vectors whose cosine is ``threshold`` or more; the class c of
    every row (id); and how many block pairs there are and how many the bounds
    left.  Vectors that are null, zero, or hold null or non-finite components
    (or whose squares overflow) take no part; vectors of different lengths are
    not compared."""
    if not -1 < threshold <= 1:
        raise ValueError("threshold must be above -1 and at most 1")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    members, classes = unit_classes(df, id_col, vec_col)
    centers = _pivots(classes, pivots, sample)
    dealt = stage(_dealt(classes, centers), "cosine-dealt")
    balls = stage(dealt.groupBy("dim", "ball").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("reach")), "cosine-balls")
    blocks = stage(_blocks(dealt, balls, block), "cosine-blocks")
    unstage(dealt)
    room = float(np.arccos(threshold)) + 1e-7

    # balls first (at most ``pivots`` a dimension), then the blocks of the balls that may meet
    spark = df.sparkSession
    at = spark.createDataFrame([(centers.shape[1], i, c) for i, c in enumerate(centers.tolist())], "dim int, ball int, center array<double>")
    a, b = _sides(balls.join(at, ["dim", "ball"], "left").select("dim", "ball", "reach", "center"), ["ball", "reach", "center"])
    apart = F.coalesce(_angle("center_a", "center_b"), F.lit(0.0)) - F.col("reach_a") - F.col("reach_b")
    meet = a.join(b, "dim").where("ball_a <= ball_b").where(apart <= room).select("dim", "ball_a", "ball_b")
    a, b = _sides(blocks.select("dim", "ball", "part", "center", "radius"), ["ball", "part", "center", "radius"])
    apart = _angle("center_a", "center_b") - F.col("radius_a") - F.col("radius_b")
    near = meet.join(a, ["dim", "ball_a"]).join(b, ["dim", "ball_b"]).where("ball_a < ball_b OR part_a <= part_b").where(apart <= room)
    near = stage(near.select("dim", "ball_a", "part_a", "ball_b", "part_b"), "cosine-near")
    count = blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.expr("n * (n + 1) div 2")).alias("n")).first()["n"]
    report = {"block_pairs": count or 0, "compared": near.count()}

    a, b = _sides(blocks.select("dim", "ball", "part", "ids", "points"), ["ball", "part", "ids", "points"])
    todo = near.join(a, ["dim", "ball_a", "part_a"]).join(b, ["dim", "ball_b", "part_b"])
    kind = classes.schema["c"].dataType.simpleString()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for r in frame.itertuples(index=False):
                p, q = (np.frombuffer(x, float).reshape(-1, r.dim) for x in (r.points_a, r.points_b))
                ids_a, ids_b = np.asarray(r.ids_a), np.asarray(r.ids_b)
                for x, y in product(range(0, len(p), TILE), range(0, len(q), TILE)):
                    if r.same and y < x:
                        continue
                    i, j = np.nonzero(p[x:x + TILE] @ q[y:y + TILE].T >= threshold - 1e-9)
                    i, j = i + x, j + y
                    if r.same and x == y:
                        i, j = i[ids_a[i] < ids_b[j]], j[ids_a[i] < ids_b[j]]
                    for lo in range(0, len(i), CHUNK):
                        s, t = i[lo:lo + CHUNK], j[lo:lo + CHUNK]
                        cosine = (p[s] * q[t]).sum(axis=1)             # the same whatever block the two are in
                        s, t, cosine = s[cosine >= threshold], t[cosine >= threshold], cosine[cosine >= threshold]
                        yield pd.DataFrame({"a": np.minimum(ids_a[s], ids_b[t]), "b": np.maximum(ids_a[s], ids_b[t]), "cosine": cosine})
    same = ((F.col("ball_a") == F.col("ball_b")) & (F.col("part_a") == F.col("part_b"))).alias("same")
    pairs = todo.select("dim", "ids_a", "ids_b", "points_a", "points_b", same).mapInPandas(compare, f"a {kind}, b {kind}, cosine double")
    return pairs, members, report
