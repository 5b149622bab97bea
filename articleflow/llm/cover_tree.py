"""Exact top-k search by inner product.

Method: dual-tree cover-tree search.  Queries and data are both indexed by
cover trees; a pair of nodes is pruned when the bound from their centres and
covering radii stays below the worst k-th score of the query group.

Vectors are turned into integers floor(SCALE * x), so scores and ties are
exact.  Bound of a pair of nodes with centres q, p and radii r, s:
q.p + r|p| + s|q| + rs.

On Spark the top levels of both trees are tables: pivots from a bounded,
documented sample (SAMPLE vectors of the smallest hash of vec_id) deal the
vectors into cells, and a cell is cut by hash into shards of about SHARD
vectors (query cells: BLOCK queries); these are dealt to tasks one by one, so a
cell that holds a third of all rows is no large task.  Every shard and every
block is one row with its centre and radius.  Blocks first search the shards of
their own cell, which gives their worst k-th scores; then the blocks meet all
other shards under the bound (a stated query set against all rows, in blocks).
That is decided before any vector moves, on rows of centres and radii: first
for a block and a whole cell (its shards' ball), then for a block and a shard.
Inside a task the subtrees are walked together.  The best k per query are
merged by a ranked window, whose limit Spark pushes below the shuffle.  Blocks
travel in piles of about PILE queries, so a shard's vectors are sent once for
each pile that has a block left under the bound, and every block is searched
from its queries' own k-th scores; a task goes on with what a block found in
the shards before.

Vectors of noise lie alike far from each other: balls do not split them, and a
node whose children would not be smaller stays a leaf.  Leaves are compared as
matrix products, whose sums are exact in the float type chosen by the norms.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do rows without vec_id; vectors are only compared with
vectors of the same length; rows that repeat a vec_id are queries and
candidates of their own (never for their own id; the k best of a query id are
those of all its rows together, each pair of rows counted); fewer than k
candidates give them all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import table

SCALE = 1024
K = 10
SAMPLE, PIVOTS = 2048, 64
SHARD, BLOCK, PILE = 8192, 512, 2048
FANOUT, LEAF, QUERY_LEAF, BASE = 16, 256, 16, 1.6
#: Data vectors that a leaf compares at a time, and queries whose best a task holds at a time.
TILE, HELD = 1024, 8192


class Node:
    """Points lo..hi of a tree's order, their centre and covering radius."""
    __slots__ = ("lo", "hi", "center", "norm", "radius", "children")

    def __init__(self, lo, hi, center, radius, children):
        self.lo, self.hi, self.center, self.radius, self.children = lo, hi, center, radius, children
        self.norm = float(np.linalg.norm(center))


def build(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, Node]:
    """Cover tree of ``points`` (float64 rows): their order and the root.  The
    children's centres are picked farthest-first until they cover the node
    within its radius / BASE (or FANOUT are picked); each point goes to its
    nearest centre.  Where one child would hold over half the points and be no
    smaller than that, balls tell the points apart no more: the node is a leaf
    (else each level of such a tree would split off a few points)."""
    order, squares = np.arange(len(points)), (points ** 2).sum(1)

    def node(lo: int, hi: int, center: np.ndarray) -> Node:
        ids = order[lo:hi]
        far = np.sqrt(((points[ids] - center) ** 2).sum(1))
        radius = float(far.max(initial=0.0))
        if hi - lo <= leaf or radius == 0.0:
            return Node(lo, hi, center, radius, [])
        own, square = points[ids], squares[ids]
        near, owner, centers = far, np.zeros(len(ids), int), [center]
        while len(centers) < FANOUT and near.max() > radius / BASE:
            c = own[near.argmax()]
            d = np.sqrt(np.maximum(square - 2 * (own @ c) + c @ c, 0))
            owner = np.where(d < near, len(centers), owner)
            near = np.minimum(near, d)
            centers.append(c)
        counts = np.bincount(owner, minlength=len(centers))
        most = int(counts.argmax())
        if counts[most] == hi - lo or 2 * counts[most] > hi - lo and near[owner == most].max() > radius / BASE:
            return Node(lo, hi, center, radius, [])
        order[lo:hi] = ids[np.argsort(owner, kind="stable")]
        ends = lo + np.cumsum(counts)
        return Node(lo, hi, center, radius, [node(int(e - c), int(e), x) for e, c, x in zip(ends, counts, centers) if c])

    return order, node(0, len(points), points.mean(axis=0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows (float64 where all sums fit in 53
    bits, else Python integers, cut to 64 bits)."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def as_floats(points: np.ndarray) -> np.ndarray:
    """The points as float32 or float64 where their products with any points
    that pass the same test are exact (the product of two norms, which no part
    of a sum exceeds, fits in 24 or 53 bits), else as long integers."""
    norm = float(np.sqrt((points.astype(np.float64) ** 2).sum(1).max(initial=0)))
    return points.astype(np.float32 if norm < 2 ** 11.9 else np.float64 if norm < 2 ** 26.4 else np.int64)


class Search:
    """The k best of each query of a block so far.  Only scores from ``floor``
    (one for all queries, or one for each) are taken."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, k: int, floor):
        order, self.root = build(points.astype(np.float64), QUERY_LEAF)
        self.ids, self.points, self.k = ids[order], points[order], k
        self.floor = np.broadcast_to(np.asarray(floor, float), len(ids))[order]
        self.kth = self.floor.copy()
        self.scores, self.found = np.zeros((2, len(ids), k), np.int64)
        self.count = np.zeros(len(ids), np.int64)
        self.last = np.full(len(ids), np.iinfo(np.int64).max)                    # a score that ties with the k-th counts up to this id

    def visit(self, q: Node, d: Node, ids: np.ndarray, points: np.ndarray) -> None:
        dot = float(q.center @ d.center)
        bound = dot + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        if bound + abs(bound) * 1e-9 + 1e-3 < self.kth[q.lo:q.hi].min():
            return
        if q.children and (not d.children or q.radius > d.radius):
            for c in q.children:
                self.visit(c, d, ids, points)
        elif d.children:
            for c in sorted(d.children, key=lambda c: -float(q.center @ c.center)):
                self.visit(q, c, ids, points)
        else:
            self._leaf(q, d, ids, points)

    def _leaf(self, q: Node, d: Node, ids: np.ndarray, points: np.ndarray) -> None:
        for lo in range(d.lo, d.hi, TILE):
            self._tile(q.lo, q.hi, ids[lo:min(lo + TILE, d.hi)], points[lo:min(lo + TILE, d.hi)])

    def _tile(self, lo: int, hi: int, ids: np.ndarray, points: np.ndarray) -> None:
        a, kth = self.points[lo:hi], self.kth[lo:hi]
        if np.int64 in (a.dtype, points.dtype):
            s = products(a.astype(np.int64), points.astype(np.int64))
        else:
            s = a @ points.T
            kth = kth.astype(s.dtype)          # float32 scores are below 2 ** 24, where a k-th score is exact or beyond them all
        hit = s >= kth[:, None]
        if np.count_nonzero(hit) > 4 * self.k * len(a) and len(ids) > self.k:      # few queries have k yet
            hit &= self.ids[lo:hi, None] != ids
            least = np.iinfo(np.int64).min if s.dtype == np.int64 else -np.inf
            hit &= s >= np.partition(np.where(hit, s, least), -self.k, axis=1)[:, -self.k, None]
        row, at = np.divmod(np.flatnonzero(hit), len(ids))
        s, found, row = s[row, at].astype(np.int64), ids[at], row + lo
        new = (self.ids[row] != found) & ((s > self.scores[row, -1]) | (found <= self.last[row]))
        s, found, row = s[new], found[new], row[new]
        if not len(row):
            return
        touched = np.unique(row)
        old = np.repeat(touched, self.count[touched])
        nth = np.arange(len(old)) - np.repeat(np.cumsum(self.count[touched]) - self.count[touched], self.count[touched])
        row, s, found = np.append(row, old), np.append(s, self.scores[old, nth]), np.append(found, self.found[old, nth])
        order = np.lexsort((found, ~s, row))
        row, s, found = row[order], s[order], found[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        top = nth < self.k
        row, nth = row[top], nth[top]
        self.scores[row, nth], self.found[row, nth] = s[top], found[top]
        self.count[touched] = np.bincount(row, minlength=len(self.ids))[touched]
        full = touched[self.count[touched] == self.k]
        self.kth[full] = np.maximum(self.floor[full], self.scores[full, -1])
        full = full[self.scores[full, -1] >= self.floor[full]]
        self.last[full] = self.found[full, -1]

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query_id, vec_id, score of what was found."""
        row = np.repeat(np.arange(len(self.ids)), self.count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        return self.ids[row], self.found[row, nth], self.scores[row, nth]


def _integers(emb: DataFrame, scale: int) -> DataFrame:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = emb.select(F.col("vec_id").cast("long"), "embedding").where("vec_id is not null").where(F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", whole.alias("v"), F.size("embedding").alias("dim"))


def _pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per length, up to PIVOTS vectors of the sample, farthest first."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    out = {}
    for dim in {r["dim"] for r in sample}:
        own = [r["v"] for r in sample if r["dim"] == dim]
        x = np.array(own, float).reshape(len(own), dim)
        picked, near = [0], ((x - x[0]) ** 2).sum(1)
        while len(picked) < PIVOTS and near.max(initial=0) > 0:
            picked.append(int(near.argmax()))
            near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(1))
        out[dim] = x[picked]
    return out


def _bytes(points: np.ndarray) -> bytes:
    """The integers in two bytes each where they fit, else in eight."""
    return points.astype(np.int16 if np.abs(points.astype(np.float64)).max(initial=0) < 2 ** 15 else np.int64).tobytes()


def _points(data: bytes, n: int, dim: int) -> np.ndarray:
    """The ``n`` vectors of length ``dim`` that ``_bytes`` wrote."""
    return np.frombuffer(data, np.int16 if len(data) == 2 * n * dim else np.int64).reshape(n, dim)


def _packed(vectors: DataFrame, pivots: dict[int, np.ndarray], size: int) -> DataFrame:
    """One row for each shard: cell, centre, radius, norm, ids, vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, v = b.column("dim").to_numpy(), b.column("v").flatten().to_numpy()
            ends = np.cumsum(dims)
            cell, data = np.zeros(len(dims), np.int32), np.full(len(dims), b"", object)
            for dim in set(dims.tolist()) - {0}:
                rows, p = np.flatnonzero(dims == dim), shared.value.get(dim)
                x = v[(ends[rows] - dim)[:, None] + np.arange(dim)]
                data[rows] = [_bytes(r) for r in x]
                if p is not None:
                    cell[rows] = ((p ** 2).sum(1)[None, :] - 2 * x.astype(float) @ p.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(data, pa.binary()), b.column("dim"), pa.array(cell)], ["vec_id", "v", "dim", "cell"])

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id").combine_chunks()
        dim, data = t["dim"][0].as_py(), t["v"].to_pylist()
        x = np.concatenate([_points(v, 1, dim) for v in data]).astype(np.int64) if len(set(map(len, data))) > 1 else _points(b"".join(data), len(data), dim)
        center = x.mean(axis=0)
        far = float(np.sqrt(((x - center) ** 2).sum(1).max(initial=0)))
        return pa.table({"dim": t["dim"][:1], "cell": t["cell"][:1], "part": t["part"][:1], "center": pa.array([center.tolist()], pa.list_(pa.float64())),
                         "radius": [far], "norm": [float(np.linalg.norm(center))], "ids": [t["vec_id"].to_numpy().tobytes()], "data": [_bytes(x)]})
    dealt = stage(vectors.select("vec_id", "v", "dim").mapInArrow(cells, "vec_id long, v binary, dim int, cell int"), "vectors")
    sizes = dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("vec_id", F.lit("part")), F.ceil(F.col("n") / size)).cast("int")
    cut = dealt.join(sizes, ["dim", "cell"]).withColumn("part", part).drop("n")
    return cut.repartition("dim", "cell", "part").groupBy("dim", "cell", "part").applyInArrow(
        pack, "dim int, cell int, part int, center array<double>, radius double, norm double, ids binary, data binary")


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Searches each row's blocks (cell, part, ids, data, floors) in its shard
    (d_*).  A block's search goes on from one shard of the task to the next, so
    it gives its k best once."""
    def best(live: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*[s.best() for s in live.values()])], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live, held = {}, 0
        for b in batches:
            for dim, d_ids, d_data, blocks in zip(b.column("dim").to_pylist(), b.column("d_ids"), b.column("d_data"), b.column("blocks")):
                ids = np.frombuffer(d_ids.as_buffer(), np.int64)
                points = _points(d_data.as_buffer(), len(ids), dim)
                order, root = build(points.astype(np.float64))
                ids, points = ids[order], as_floats(points[order])
                for q in blocks:
                    key = dim, q["cell"].as_py(), q["part"].as_py()
                    if key not in live:
                        qids = np.frombuffer(q["ids"].as_buffer(), np.int64)
                        if live and held + len(qids) > HELD:
                            yield best(live)
                            live, held = {}, 0
                        live[key] = Search(qids, as_floats(_points(q["data"].as_buffer(), len(qids), dim)), k, q["floors"].values.to_numpy())
                        held += len(qids)
                    search = live[key]
                    search.visit(search.root, root, ids, points)
        if live:
            yield best(live)
    return pairs.select("dim", "d_ids", "d_data", "blocks").mapInArrow(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(emb: DataFrame, every: int = 100, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose vec_id is
    divisible by ``every``, the k other vectors of the highest scores, ties to
    the smaller vec_id."""
    vectors = stage(_integers(emb, scale), "vectors-int")
    pivots = _pivots(vectors)
    shards = stage(_packed(vectors, pivots, SHARD), "shards")
    blocks = stage(_packed(vectors.where(F.col("vec_id") % every == 0), pivots, BLOCK), "blocks")
    d = shards.select("dim", *[F.col(c).alias(f"d_{c}") for c in shards.columns[1:]])
    q = blocks.select("dim", *[F.col(c).alias(f"q_{c}") for c in blocks.columns[1:]])

    none = F.transform(F.sequence(F.lit(1), (F.octet_length("q_ids") / 8).cast("int")), lambda _: F.lit(float("-inf")))
    one = F.array(F.struct(F.col("q_cell").alias("cell"), F.col("q_part").alias("part"), F.col("q_ids").alias("ids"), F.col("q_data").alias("data"), none.alias("floors")))
    own = q.join(d, (q["dim"] == d["dim"]) & (F.col("q_cell") == F.col("d_cell"))).drop(q["dim"]).withColumn("blocks", one)
    home = stage(_best(_search(own, k), k).select("query_id", "vec_id", "score", "rank"), "home")
    kth = home.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))     # one row a query id
    piles = stage(_piles(blocks, kth), "piles")

    pairs = stage(_surviving(shards, blocks, piles), "pairs")
    rest = pairs.join(piles.select(F.col("dim").alias("__dim"), F.col("pile").alias("__pile"), F.col("cell").alias("__cell"), F.col("part").alias("__part"),
                                   F.struct("cell", "part", "ids", "data", "floors").alias("block")),
                      (F.col("dim") == F.col("__dim")) & (F.col("q_cell") == F.col("__cell")) & (F.col("q_part") == F.col("__part")))
    rest = rest.groupBy("dim", "d_cell", "d_part", "__pile").agg(F.collect_list("block").alias("blocks"))    # at most a pile's blocks
    rest = rest.join(d, ["dim", "d_cell", "d_part"])
    found = home.select("query_id", "vec_id", "score").unionByName(_search(rest, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _bound(q: str, d: str) -> Column:
    """The greatest score that a query in ball q may have in ball d."""
    dot = F.aggregate(F.zip_with(f"{q}_center", f"{d}_center", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    bound = dot + F.col(f"{q}_radius") * F.col(f"{d}_norm") + F.col(f"{d}_radius") * F.col(f"{q}_norm") + F.col(f"{q}_radius") * F.col(f"{d}_radius")
    return bound + F.abs(bound) * 1e-9 + 1e-3


def _surviving(shards: DataFrame, blocks: DataFrame, piles: DataFrame) -> DataFrame:
    """(dim, q_cell, q_part, d_cell, d_part): the blocks and the shards of other
    cells that may hold a score above the block's worst k-th one."""
    worst = piles.select("dim", F.col("cell").alias("q_cell"), F.col("part").alias("q_part"), F.array_min("floors").alias("worst"))
    ball = ["center", "radius", "norm"]
    q = blocks.select("dim", F.col("cell").alias("q_cell"), F.col("part").alias("q_part"), *[F.col(c).alias(f"q_{c}") for c in ball])
    d = shards.select("dim", F.col("cell").alias("d_cell"), F.col("part").alias("d_part"), *[F.col(c).alias(f"d_{c}") for c in ball])
    # a cell's ball: around its least shard's centre, out to the far end of every shard
    first = d.groupBy("dim", "d_cell").agg(F.min_by(F.struct("d_center", "d_norm"), "d_part").alias("f"))
    gap = F.sqrt(F.aggregate(F.zip_with("d_center", "f.d_center", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    cells = d.join(first, ["dim", "d_cell"]).groupBy("dim", "d_cell").agg(
        F.first("f").alias("f"), F.max(gap + F.col("d_radius")).alias("c_radius"))
    cells = cells.select("dim", "d_cell", F.col("f.d_center").alias("c_center"), F.col("f.d_norm").alias("c_norm"), "c_radius")
    near = q.join(worst, ["dim", "q_cell", "q_part"]).join(cells, "dim").where("q_cell <> d_cell").where(_bound("q", "c") >= F.col("worst"))
    return near.drop("c_center", "c_norm", "c_radius").join(d, ["dim", "d_cell"]).where(_bound("q", "d") >= F.col("worst")) \
        .select("dim", "q_cell", "q_part", "d_cell", "d_part")


def _piles(blocks: DataFrame, kth: DataFrame) -> DataFrame:
    """The blocks with their queries' k-th scores (``floors``, none until a query
    has k) and a pile: by hash, about PILE queries each."""
    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids = np.frombuffer(r.ids, np.int64)
                yield pd.DataFrame({"dim": r.dim, "cell": r.cell, "part": r.part, "at": np.arange(len(ids)), "query_id": ids})
    each = blocks.select("dim", "cell", "part", "ids").mapInPandas(members, "dim int, cell int, part int, at int, query_id long")
    floor = F.struct("at", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
    floors = each.join(kth, "query_id", "left").groupBy("dim", "cell", "part").agg(F.array_sort(F.collect_list(floor))["kth"].alias("floors"))
    sizes = each.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    pile = F.pmod(F.xxhash64("cell", "part"), F.ceil(F.col("n") / PILE))
    return blocks.join(floors, ["dim", "cell", "part"]).join(sizes, "dim").withColumn("pile", pile).drop("n")


def op3_top_k(spark, sf_dir):
    """query_id, rank, vec_id, score of the K best of each query."""
    return top_k(table(spark, sf_dir, "embeddings"))
