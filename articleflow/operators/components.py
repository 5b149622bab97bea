"""Connected components, exact, for any diameter.

``connected_components`` alternates the large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) on an
edge table until the table no longer changes, which leaves one star per
component around its smallest id.  Every node links straight to the smallest
id it has seen, so the number of rounds grows with the logarithm of the
graph, not with its diameter, and there is no round cap.  Each round is an
aggregate (combined map-side) and a join that AQE may split, so a hub with a
third of all rows is no bottleneck.  Each round's edges are staged as a table
in the shared checkpoint folder, which cuts the lineage, and the round before
is removed.

``components`` links documents that share a key (e.g. the normalised title
hash or the hash of the whole text): every document links to its key's
smallest document, so no pair of documents of a key is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage, unstage


def key_edges(df: DataFrame, id_col: str, keys: dict[str, object]) -> DataFrame:
    """(id, key) edges: one per document and key kind; NULL keys link nothing."""
    parts = []
    for kind, expr in keys.items():
        parts.append(df.select(F.col(id_col).alias("id"),
                               F.concat(F.lit(kind + ":"), expr).alias("key")).where(F.col("key").isNotNull()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every id on an edge; component = its smallest id.

    NULL ends and self loops link nothing.  Ids may be of any ordered type."""
    cur = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
                .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct(), "cc-edges")
    size = (F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = cur.agg(*size).first()
    while seen[0]:
        new = stage(_small_star(_large_star(cur)), "cc-edges")
        now = new.agg(*size).first()
        unstage(cur)
        cur, before, seen = new, seen, now
        if now == before:
            break
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")) \
        .unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of documents linked by shared keys, singletons included.

    The (id, key) table is staged once (keys are hashes of whole texts)."""
    edges = stage(edges, "cc-keys")
    first = edges.groupBy("key").agg(F.min("id").alias("first"))
    linked = connected_components(edges.join(first, "key").where(F.col("first") != F.col("id"))
                                  .select("id", "first"), "id", "first")
    return edges.select("id").distinct().join(linked, "id", "left") \
        .select("id", F.coalesce("component", "id").alias("component"))


def groups(labels: DataFrame, min_size: int = 2) -> DataFrame:
    """Members of components with at least ``min_size`` documents."""
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return labels.join(sizes.where(F.col("size") >= min_size), "component").select("id", "component", "size")
