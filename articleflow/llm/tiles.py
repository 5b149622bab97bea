"""Comparison of the members of groups, in tiles of bounded size.

A group (all rows that share a blocking key) may hold a third of all rows, so
it is never handed to one task whole: its members are dealt by hash into
tiles, and every pair of tiles is a unit of work of its own.  Units are packed
into Spark groups, because one Spark group per small unit costs more than the
comparison: neighbouring units of a large group, as many as fill half a pack,
make up a pack of their own; groups of one tile share packs by hash, each half
full on average.  So a pack stays within its size however large a group is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 2048
PACK = 32768


def tile_pairs(members: DataFrame, key: str, item: Column, tile: int = TILE, pack: int = PACK) -> DataFrame:
    """``members`` (one row per key and member) of keys with two members or
    more, repeated for each pair of tiles that the member's tile is in:
    ``__u`` names the unit, ``__side`` is 0 or 1 (a unit of one tile has only
    side 0), ``__pack`` is the Spark group."""
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("__c")).where("__c > 1")
    small = sizes.where(F.col("__c") <= tile).agg(F.sum("__c")).first()[0] or 0
    packs, each = max(1, 2 * small // pack), max(1, pack // (4 * tile))
    dealt = members.join(sizes, key).withColumn("__tiles", F.ceil(F.col("__c") / tile).cast("int")) \
        .withColumn("__i", F.pmod(F.xxhash64(item, F.lit("tile")), F.col("__tiles")).cast("int"))
    other = dealt.withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("__tiles") - 1)))
    low, high = F.least("__i", "__j").cast("long"), F.greatest("__i", "__j").cast("long")
    number = F.expr("__high * (__high + 1) div 2 + __low")
    own = F.pmod(F.xxhash64(F.col(key), F.lit("pack")), F.lit(packs))
    other = other.withColumn("__low", low).withColumn("__high", high).withColumn("__n", number)
    shared = F.xxhash64(F.col(key), F.expr(f"__n div {each}"))
    return other.withColumn("__u", F.xxhash64(F.col(key), "__low", "__high")).withColumn("__side", (F.col("__i") > F.col("__j")).cast("int")) \
        .withColumn("__pack", F.when(F.col("__tiles") == 1, own).otherwise(shared)).drop("__c", "__tiles", "__i", "__j", "__low", "__high", "__n")


class Links:
    """Union-find over the members of a unit; only links that join two parts
    are kept, so a unit of n members gives fewer than n links."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links a[i] - b[i]."""
        while True:
            la, lb = self.of[a], self.of[b]
            apart = la != lb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            low, high = np.minimum(la[apart], lb[apart]), np.maximum(la[apart], lb[apart])
            root = np.arange(len(self.of))
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
            self.of = root[self.of]

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """(member, root) of every member that is not its part's root."""
        member = np.flatnonzero(self.of != np.arange(len(self.of)))
        return member, self.of[member]
