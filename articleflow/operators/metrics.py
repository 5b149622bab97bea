"""Counts and health metrics.

All are hash aggregates; the few one-row results are combined with
cross joins of one-row frames (no data-sized broadcast).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.labels import display_label


def _count(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def raw_counts(raw: DataFrame) -> DataFrame:
    """A1: total raw rows and rows with status ok."""
    return raw.agg(_count("total"), F.count_if(F.col("crawl_status") == "ok").alias("ok"))


def category_counts(articles: DataFrame) -> DataFrame:
    """A2: visible articles per category (NULL -> the default literal)."""
    return articles.where(~F.col("is_duplicate")).groupBy(
        F.coalesce(F.col("category"), F.lit(K.DEFAULT_CATEGORY)).alias("category")).agg(_count())


def daily_counts(articles: DataFrame) -> DataFrame:
    """A3: visible, dated articles per day."""
    return articles.where(~F.col("is_duplicate") & F.col("published_at").isNotNull()).groupBy(
        F.col("published_at").alias("day")).agg(_count())


def recent_days(articles: DataFrame, k: int = 5) -> DataFrame:
    """T5: the last ``k`` days with data (from the per-day counts: one row
    per calendar day, so the ordering is over a small frame)."""
    return daily_counts(articles).orderBy(F.col("day").desc()).limit(k)


def source_counts(articles: DataFrame) -> DataFrame:
    """A4: visible articles per source (NULL -> the default literal)."""
    return articles.where(~F.col("is_duplicate")).groupBy(
        F.coalesce(F.col("source"), F.lit(K.DEFAULT_SOURCE)).alias("source")).agg(_count())


def sentiment_overall(summaries: DataFrame) -> DataFrame:
    """A5 overall: summaries per sentiment (NULL -> 'unknown')."""
    return summaries.groupBy(F.coalesce(F.col("sentiment"), F.lit("unknown")).alias("sentiment")).agg(_count())


def sentiment_by_category(articles: DataFrame, summaries: DataFrame) -> DataFrame:
    """A5 per category (J2): summaries INNER articles; duplicates count."""
    j = summaries.join(articles.select(F.col("id").alias("article_id"), "category"), "article_id", "inner")
    return j.groupBy(F.coalesce(F.col("category"), F.lit(K.DEFAULT_CATEGORY)).alias("category"),
                     F.coalesce(F.col("sentiment"), F.lit("unknown")).alias("sentiment")).agg(_count())


PIVOT_LABELS = ("positive", "neutral", "negative", "unknown")


def sentiment_pivot(articles: DataFrame, summaries: DataFrame) -> DataFrame:
    """Per category, one 0-filled count column per display label."""
    by = sentiment_by_category(articles, summaries)
    disp = display_label(F.col("sentiment"))
    cols = []
    for lab in PIVOT_LABELS:
        cols.append(F.sum(F.when(disp == K.LABEL_DISPLAY[lab], F.col("n")).otherwise(0)).cast("long").alias(lab))
    return by.groupBy("category").agg(*cols)


def _one_row_join(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.crossJoin(b), frames)


def quality_metrics(raw: DataFrame, clean: DataFrame, summaries: DataFrame) -> DataFrame:
    """Totals, ok-rate %, duplicates, raw - clean (floored), coverage %,
    mean compression % (0-length guarded).  One row."""
    r = raw_counts(raw).withColumnRenamed("total", "raw_total").withColumnRenamed("ok", "raw_ok")
    c = clean.agg(_count("clean_total"), F.count_if(F.col("is_duplicate")).alias("duplicates"))
    s = summaries.agg(_count("summarized"),
                      F.avg(F.col("summary_len").cast("double") / F.nullif(F.col("orig_len"), F.lit(0))).alias("comp"))
    j = _one_row_join([r, c, s])
    active = F.greatest(F.col("clean_total") - F.col("duplicates"), F.lit(0))
    return j.select(
        "raw_total", "raw_ok",
        F.round(F.when(F.col("raw_total") > 0, F.col("raw_ok") / F.col("raw_total") * 100).otherwise(0.0), 6)
        .alias("crawl_success_rate"),
        "clean_total", "duplicates",
        F.when(F.col("raw_total") >= F.col("clean_total"), F.col("raw_total") - F.col("clean_total"))
        .otherwise(0).cast("long").alias("dedup_removed"),
        "summarized",
        F.round(F.when(active > 0, F.col("summarized") / active * 100).otherwise(0.0), 6).alias("summary_coverage"),
        F.round(F.coalesce(F.col("comp") * 100, F.lit(0.0)), 6).alias("avg_compression"),
    )


def article_count(df: DataFrame) -> DataFrame:
    """Filtered count without materialising rows."""
    return df.agg(_count())


def health_metrics(raw: DataFrame, processed_ids: DataFrame, articles: DataFrame, summaries: DataFrame,
                   as_of: str, recent: int = 5) -> DataFrame:
    """A18 for an explicit ``as_of`` day: rows collected that day, failed
    extractions, clean backlog (raw ids not in the processed ledger),
    summary backlog, the last ``recent`` days with data and the quality
    ratios.  One row."""
    r = raw.agg(
        F.count_if(F.substring(F.col("collected_at"), 1, 10) == as_of).alias("collected_today"),
        F.count_if(F.col("crawl_status") == "failed").alias("failed_crawl"))
    backlog = raw.select(F.col("id").alias("raw_id")).join(processed_ids.select("raw_id"), "raw_id", "left_anti") \
        .agg(_count("uncleaned"))
    vis = articles.where(~F.col("is_duplicate"))
    unsum = vis.join(summaries.select(F.col("article_id").alias("id")), "id", "left_anti").agg(_count("unsummarized"))
    days = recent_days(articles, recent).agg(
        F.array_sort(F.collect_list(F.col("day").cast("string"))).alias("recent_days"))
    today_pub = daily_counts(articles).where(F.col("day") == F.lit(as_of).cast("date")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("published_today"))
    return _one_row_join([r, backlog, unsum, days, today_pub]).select(
        F.lit(as_of).alias("as_of"), "collected_today", "published_today", "failed_crawl", "uncleaned",
        "unsummarized", "recent_days")


WARNING_RULES = ("run_log_missing", "last_run_failed", "nothing_collected_today", "clean_backlog",
                 "low_summary_coverage")


def health_warnings(health: DataFrame, quality: DataFrame, run_log: DataFrame | None = None,
                    coverage_floor: float = K.COVERAGE_WARN_PCT) -> DataFrame:
    """One row per triggered rule (empty = healthy).  A missing run
    *today* is not a warning; a missing or failed run log is."""
    if run_log is None:
        last = health.select(F.lit(None).cast("string").alias("last_status"))
    else:
        last = run_log.agg(F.max_by(F.col("status"), F.col("run_at")).alias("last_status"))
    j = _one_row_join([health, quality.select("summary_coverage"), last])
    rules = [
        ("run_log_missing", F.col("last_status").isNull()),
        ("last_run_failed", F.col("last_status").isNotNull() & (F.col("last_status") != "ok")),
        ("nothing_collected_today", F.col("collected_today") == 0),
        ("clean_backlog", F.col("uncleaned") > 0),
        ("low_summary_coverage", (F.col("unsummarized") > 0) & (F.col("summary_coverage") < coverage_floor)),
    ]
    arr = F.array(*[F.struct(F.lit(name).alias("rule"), cond.alias("hit")) for name, cond in rules])
    return j.select(F.explode(arr).alias("r")).where(F.col("r.hit")).select(F.col("r.rule").alias("rule"))
