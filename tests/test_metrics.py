"""Counts, quality metrics, health rules, paging and the pivot."""

import datetime

from pyspark.sql import functions as F

from articleflow.operators import articles as AR
from articleflow.operators import metrics as MT

D = datetime.date


def _articles(spark):
    rows = [(1, "t1", "IT", "s1", D(2026, 7, 21), False), (2, "t2", "IT", "s2", D(2026, 7, 22), False),
            (3, "t3", None, None, None, False), (4, "t4", "IT", "s1", D(2026, 7, 22), True)]
    return spark.createDataFrame(rows, "id long, title string, category string, source string, published_at date, "
                                       "is_duplicate boolean")


def _summaries(spark, rows):
    return spark.createDataFrame(rows, "article_id long, summary string, orig_len long, summary_len long, "
                                       "sentiment string, model string")


def test_counts_hide_duplicates_and_fill_nulls(spark):
    a = _articles(spark)
    assert {r["category"]: r["n"] for r in MT.category_counts(a).collect()} == {"IT": 2, "미분류": 1}
    assert {r["source"]: r["n"] for r in MT.source_counts(a).collect()} == {"s1": 1, "s2": 1, "미상": 1}
    assert {r["day"]: r["n"] for r in MT.daily_counts(a).collect()} == {D(2026, 7, 21): 1, D(2026, 7, 22): 1}


def test_quality_metrics(spark):
    raw = spark.createDataFrame([("ok",), ("ok",), ("failed",), ("ok",), ("ok",)], "crawl_status string")
    s = _summaries(spark, [(1, "x", 100, 20, "positive", "m"), (4, "y", 0, 5, None, "m")])
    q = MT.quality_metrics(raw, _articles(spark), s).first()
    assert q["raw_total"] == 5 and q["raw_ok"] == 4 and q["crawl_success_rate"] == 80.0
    assert q["clean_total"] == 4 and q["duplicates"] == 1 and q["dedup_removed"] == 1
    assert q["summary_coverage"] == round(2 / 3 * 100, 6)        # a flagged row may count (N1)
    assert q["avg_compression"] == 20.0                            # 0-length original ignored


def test_quality_metrics_empty(spark):
    raw = spark.createDataFrame([], "crawl_status string")
    a = spark.createDataFrame([], "id long, is_duplicate boolean")
    s = _summaries(spark, [])
    q = MT.quality_metrics(raw, a, s).first()
    assert q["crawl_success_rate"] == 0.0 and q["summary_coverage"] == 0.0 and q["avg_compression"] == 0.0


def test_sentiment_pivot_zero_filled(spark):
    s = _summaries(spark, [(1, "x", 1, 1, "positive", "m"), (2, "x", 1, 1, None, "m"), (3, "x", 1, 1, "weird", "m")])
    got = {r["category"]: r.asDict() for r in MT.sentiment_pivot(_articles(spark), s).collect()}
    assert got["IT"] == {"category": "IT", "positive": 1, "neutral": 0, "negative": 0, "unknown": 1}
    assert got["미분류"]["unknown"] == 1


def test_health_warnings_rules(spark):
    health = spark.createDataFrame([(0, 3, 0)], "collected_today long, uncleaned long, unsummarized long")
    quality = spark.createDataFrame([(50.0,)], "summary_coverage double")
    rules = {r["rule"] for r in MT.health_warnings(health, quality).collect()}
    assert rules == {"run_log_missing", "nothing_collected_today", "clean_backlog"}
    log = spark.createDataFrame([("2026-07-21T06:00", "ok"), ("2026-07-22T06:00", "failed")],
                                "run_at string, status string")
    rules = {r["rule"] for r in MT.health_warnings(health, quality, log).collect()}
    assert "last_run_failed" in rules and "run_log_missing" not in rules


def test_article_page_bounds(spark):
    a = _articles(spark).withColumn("body", F.lit("b"))
    p1 = AR.article_page(a, page=1, page_size=2).collect()
    assert [r["id"] for r in p1] == [4, 2] and p1[0]["total"] == 4 and p1[0]["last_page"] == 2
    assert [r["id"] for r in AR.article_page(a, page=2, page_size=2).collect()] == [1, 3]   # NULL date last
    assert AR.article_page(a, page=9, page_size=2).count() == 0
    assert AR.article_page(a, page=0, page_size=0).count() == 1      # clamped to page 1, size 1
