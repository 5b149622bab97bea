"""The report as ordered sections, and its sink.

Each input is read once, into a narrow staged table (statuses; titles, keys and
days; lengths and labels); every section comes from these.  Counts by category
and by source are one aggregate over grouping sets, new and rising keywords
share one table of counts.

The sink writes one file a range of (section, rank), so the files in name order
are the report in order, however long a section is; a version is complete with
its ``_SUCCESS`` file, and the newest complete one is what readers see.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..session import stage
from . import metrics as MT
from . import trends as TR
from .digest import INSIGHT_ARRAYS
from .ranking import RankedTable
from .store import children

REPORT_COLUMNS = ("section", "rank", "key", "n", "value")
#: Sections in the order of the report.
SECTIONS = ("metrics", "category", "keyword", "source", "sentiment", "trend_new", "trend_rising", "event", "tone", "insight")
METRICS = ("raw_total", "raw_ok", "crawl_success_rate", "clean_total", "duplicates", "dedup_removed", "summarized", "summary_coverage", "avg_compression")


def _rows(df: DataFrame, section: str, key: Column, n: Column | None = None, value: Column | None = None) -> DataFrame:
    """Report rows of a frame that has its ``rank``."""
    return df.select(F.lit(section).alias("section"), F.col("rank").cast("long"), key.cast("string").alias("key"),
                     (n if n is not None else F.lit(None)).cast("long").alias("n"), (value if value is not None else F.lit(None)).cast("double").alias("value"))


def _top(df: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows with their rank."""
    return df.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(Window.orderBy(*order)))   # at most top rows


def _all(df: DataFrame, order: list[Column]) -> DataFrame:
    return RankedTable(df, order).ranked("rank")


def report_rows(raw: DataFrame, articles: DataFrame, summaries: DataFrame, events: DataFrame | None = None, tones: DataFrame | None = None,
                insight: DataFrame | None = None, top_n: int = K.TOP_N, trend_days: int = K.TREND_DAYS) -> DataFrame:
    """A17 as sections (section, rank, key, n, value): quality metrics, top
    categories, top title keywords, all sources, sentiments, new and rising
    keywords; and where given, the largest ``events`` (V8; n members, value
    outlets), their tones (V10; key verdict and labels, n and value the labels'
    counts) and the texts of the latest ``insight`` record (A16)."""
    r = stage(raw.select("crawl_status"), "report-raw")
    a = stage(articles.select("id", "title", "category", "source", "published_at", "is_duplicate"), "report-articles")
    s = stage(summaries.select("article_id", "orig_len", "summary_len", "sentiment"), "report-summaries")
    n, by_n = F.col("n"), [F.col("n").desc()]
    q = MT.quality_metrics(r, a, s)
    metrics = q.select(F.posexplode(F.array(*[F.struct(F.lit(m).alias("key"), F.col(m).cast("double").alias("value")) for m in METRICS])).alias("rank", "m"))
    out = [_rows(metrics.withColumn("rank", F.col("rank") + 1), "metrics", F.col("m.key"), None, F.col("m.value"))]
    keys = a.where(~F.col("is_duplicate")).select(F.coalesce("category", F.lit(K.DEFAULT_CATEGORY)).alias("category"),
                                                  F.coalesce("source", F.lit(K.DEFAULT_SOURCE)).alias("source"))
    counts = stage(keys.groupingSets([["category"], ["source"]], "category", "source").agg(F.count(F.lit(1)).alias("n")), "report-counts")
    out.append(_rows(_top(counts.where("category IS NOT NULL"), [*by_n, F.col("category")], top_n), "category", F.col("category"), n))
    out.append(_rows(_top(TR.top_keywords(a, top_n), [*by_n, F.col("token")], top_n), "keyword", F.col("token"), n))
    out.append(_rows(_all(counts.where("source IS NOT NULL"), [*by_n, F.col("source")]), "source", F.col("source"), n))
    labels = MT.sentiment_overall(s).withColumn("rank", F.row_number().over(Window.orderBy(*by_n, "sentiment")))     # one row a label
    out.append(_rows(labels, "sentiment", F.col("sentiment"), n))
    brief = stage(TR.briefing_counts(a, trend_days), "report-briefing")
    today, newest = F.col("today_n"), [F.col("today_n").desc(), F.col("token")]
    out.append(_rows(_top(TR.new_keywords(brief), newest, top_n), "trend_new", F.col("token"), today))
    rising = TR.rising_keywords(brief).withColumn("prior_avg", F.round("prior_avg", 6))
    out.append(_rows(_top(rising, newest, top_n), "trend_rising", F.col("token"), today, F.col("prior_avg")))
    if events is not None:
        largest = stage(_top(events, [F.col("size").desc(), F.col("cluster")], top_n), "report-events")
        out.append(_rows(largest, "event", F.col("rep_title"), F.col("size"), F.col("n_sources")))
        if tones is not None:
            told = largest.select("rank", "cluster").join(tones, "cluster")
            out.append(_rows(told, "tone", F.concat_ws(" ", "verdict", "label1", "label2"), F.col("n1"), F.col("n2")))
    if insight is not None:
        texts = insight.select(F.posexplode(F.concat(*INSIGHT_ARRAYS)).alias("rank", "text"))
        out.append(_rows(texts.withColumn("rank", F.col("rank") + 1), "insight", F.col("text")))
    return reduce(lambda x, y: x.unionByName(y), out)


def write_report(rows: DataFrame, path: str) -> str:
    """A new version of the report under ``path``: CSV files that hold, in
    name order, the sections in order and each by rank.  Returns its folder."""
    spark = rows.sparkSession
    place = reduce(lambda c, k: c.when(F.col("section") == SECTIONS[k], k), range(1, len(SECTIONS)), F.when(F.col("section") == SECTIONS[0], 0))
    order = [F.col("__section"), F.col("rank"), F.col("key")]
    ordered = rows.withColumn("__section", place.otherwise(len(SECTIONS))).repartitionByRange(*order).sortWithinPartitions(*order)
    folder = f"{path.rstrip('/')}/v={max([0, *map(int, children(spark, path, 'v='))]) + 1}"
    ordered.select(*REPORT_COLUMNS).write.options(header=True, quoteAll=True, quote='"', escape='"').csv(folder)
    return folder


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a report."""
    done = children(spark, path, "v=", complete=True)
    if not done:
        raise FileNotFoundError(path)
    return spark.read.schema("section string, rank long, key string, n long, value double") \
        .options(header=True, quote='"', escape='"', multiLine=True).csv(f"{path.rstrip('/')}/v={max(map(int, done))}")
