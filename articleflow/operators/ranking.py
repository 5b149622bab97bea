"""Exact ranks and deep pages of an ordered table.

The rows are range-partitioned by a total order, sorted within each range and
written with their place in it, one folder a range.  The ranges' sizes and
their prefix sums (one row a range, on the driver) are an order-statistic index:
a row's rank is its range's offset plus its place, and a page is in the one or
two ranges that its ranks fall into, whatever its number; only their folders
are read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


class RankedTable:
    """``df`` in the total order ``order`` (ties must be broken by a unique
    column), ranked from 1."""

    def __init__(self, df: DataFrame, order: list[Column]):
        spark = df.sparkSession
        self.columns = df.columns
        path = f"{checkpoint_dir(spark).rstrip('/')}/tables/ranked-{uuid.uuid4().hex}"
        cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
        # the low 33 bits of the increasing id count the rows of a partition
        at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        cut.withColumn("__at", at).withColumn("__range", F.spark_partition_id()).write.partitionBy("__range").parquet(path)
        self.rows = spark.read.schema(cut.withColumn("__at", at).withColumn("__range", F.spark_partition_id()).schema).parquet(path)
        sizes = sorted((r["__range"], r["n"]) for r in self.rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())
        self.ranges, self.offsets, self.total = [k for k, _ in sizes], [], 0
        for _, n in sizes:
            self.offsets.append(self.total)
            self.total += n

    def ranked(self, name: str = "rank") -> DataFrame:
        """All rows with their rank."""
        spark = self.rows.sparkSession
        offsets = spark.createDataFrame(list(zip(self.ranges, self.offsets)), "__range int, __offset long")     # one row a range
        return self.rows.join(F.broadcast(offsets), "__range").select(*self.columns, (F.col("__offset") + F.col("__at") + 1).alias(name))

    def between(self, first: int, last: int, name: str = "rank") -> DataFrame:
        """The rows of the ranks ``first`` to ``last``."""
        lo = max(bisect_right(self.offsets, first - 1) - 1, 0)
        hi = max(bisect_right(self.offsets, last - 1), lo)
        near = list(zip(self.ranges, self.offsets))[lo:hi] if first <= self.total and last >= first else []
        offset = F.lit(0).cast("long")
        for k, n in near:
            offset = F.when(F.col("__range") == k, F.lit(n).cast("long")).otherwise(offset)
        rank = offset + F.col("__at") + 1
        return self.rows.where(F.col("__range").isin([k for k, _ in near]) if near else F.lit(False)) \
            .withColumn(name, rank).where(F.col(name).between(first, last)).select(*self.columns, name)

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) of ``size`` rows, with the page, the total
        and the last page; a page past the end is empty."""
        number, size = max(int(number), 1), max(int(size), 1)
        rows = self.between((number - 1) * size + 1, number * size)
        last = -(-self.total // size)
        return rows.select(*self.columns, F.lit(number).cast("long").alias("page"), F.lit(self.total).cast("long").alias("total"),
                           F.lit(last).cast("long").alias("last_page"))
