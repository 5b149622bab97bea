"""Keyed first/last-wins and first-in-group flags.

All of them are aggregations (partial + final hash aggregate, so a hot key
is combined map-side before the shuffle) followed, where the full row is
needed, by an equi-join that AQE can split when one key is skewed.  None
uses a window partitioned by the key: such a window sorts a whole hot
group inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str] | str, order: str) -> DataFrame:
    """One row per key: the row with the smallest ``order`` (first wins)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str] | str, order: str) -> DataFrame:
    """One row per key: the row with the largest ``order`` (last wins)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def flag_later_in_group(df: DataFrame, key: str, order: str, flag: str,
                        exempt: Column | None = None) -> DataFrame:
    """``flag`` = the row is not the first (by ``order``) of its ``key`` group.

    ``exempt`` rows are never flagged (e.g. an empty normalised title).
    """
    firsts = df.groupBy(key).agg(F.min(order).alias("_first"))
    out = df.join(firsts, on=key, how="left")
    cond = F.coalesce(F.col(order) != F.col("_first"), F.lit(False))
    if exempt is not None:
        cond = cond & ~F.coalesce(exempt, F.lit(False))
    return out.withColumn(flag, cond).drop("_first")


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    salt_buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """Exact top-``k`` rows per group, skew-safe.

    Phase 1 ranks inside (group, salt) sub-groups, so a hot group is spread
    over ``salt_buckets`` tasks, and keeps each sub-group's top k (the
    group's top k is among them).  Phase 2 ranks the at most
    ``k * salt_buckets`` survivors per group.  ``order`` must be a total
    order (ties broken by a unique column).
    """
    from pyspark.sql import Window

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    first = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return first.withColumn(rank_col, F.row_number().over(w2).cast("long")).where(F.col(rank_col) <= k) \
        .drop("_salt", "_r1")
