"""Ranked tables: exact ranks and pages, also of null and equal values; a page
reads its range only."""

import re

from pyspark.sql import functions as F

from articleflow.operators import articles as AR
from articleflow.operators.ranking import RankedTable


def table(spark, n):
    day = F.when(F.col("id") % 11 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")))
    return spark.range(0, n, 1, 6).select("id", day.alias("published_at"), F.lit("x").alias("body"))


def test_ranks_and_pages(spark):
    n = 3000
    df = table(spark, n)
    want = [r["id"] for r in sorted(df.collect(), key=lambda r: (r["published_at"] is None, -(r["published_at"].toordinal() if r["published_at"] else 0), -r["id"]))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranked = AR.ranked_articles(df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ranked.ranges) > 1 and ranked.total == n
    got = {r["rank"]: r["id"] for r in ranked.ranked().collect()}
    assert [got[i + 1] for i in range(n)] == want
    for page, size in ((1, 10), (7, 10), (150, 20), (300, 10), (301, 10), (1, 5000), (2, 2999), (0, 0)):
        rows = ranked.page(page, size).collect()
        lo = (max(page, 1) - 1) * max(size, 1)
        assert {r["id"] for r in rows} == set(want[lo:lo + max(size, 1)])
        assert all((r["total"], r["last_page"], r["page"]) == (n, -(-n // max(size, 1)), max(page, 1)) for r in rows)


def test_a_deep_page_reads_one_range(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranked = AR.ranked_articles(table(spark, 4000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    k = len(ranked.ranges) - 1
    number = (ranked.offsets[k] + 50) // 10 + 1
    page = ranked.page(number, 10)
    assert page.count() == 10
    plan = page._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert {int(x) for x in re.findall(r"(?<![#\w])\d+", filters)} == {ranked.ranges[k]}      # one folder of all is listed
    assert "TakeOrdered" not in plan and "Exchange" not in plan


def test_empty(spark):
    ranked = RankedTable(table(spark, 0), AR.newest_first())
    assert ranked.total == 0 and ranked.page(1, 10).count() == 0 and ranked.ranked().count() == 0
