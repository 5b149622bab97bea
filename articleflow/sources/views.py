"""Article-layer views over the driver tables.

``article_view``   A: the clean article table, one row per document.
``summaries_view`` summaries for every labelled document (offline summary,
                   sentiment taken from the label).
``raw_view``       R: raw rows fetched from ``pages`` (S6 extraction).
``raw_plus_view``  R+: R plus re-fetched copies and broken rows, so that
                   cleaning, url dedup and title dedup have work to do.

Every view is a lazy DataFrame derived from the parquet tables; its work
grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..functions.urls import url_first_segment, url_host
from ..operators.dedup import flag_later_in_group
from .pages import with_extracted
from .tables import read_table

EPOCH = "2024-01-01"
N_DAYS = 14


def _day_of(idcol: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), F.pmod(idcol, F.lit(N_DAYS)).cast("int"))


# --------------------------------------------------------------------------
# A: articles
# --------------------------------------------------------------------------
def _articles(documents: DataFrame) -> DataFrame:
    line = T.first_line(F.col("text"))
    return documents.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        line.alias("title"),
        T.title_hash(line).alias("title_hash"),
        (T.title_key(line) == "").alias("_empty_key"),
        F.col("text").alias("body"),
        F.col("lang").alias("category"),
        F.col("source"),
        _day_of(F.col("doc_id")).alias("published_at"),
    )


def article_view(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None) -> DataFrame:
    """The articles of all documents, or of ``documents``, some rows of the table
    (their flags are those that they have among all)."""
    base = _articles(read_table(spark, sf_dir, "documents"))
    # W3 over the whole table: later rows of a title hash are near duplicates.  They
    # are found without bodies; those move once, by id, as joins of the summaries need them.
    flagged = flag_later_in_group(base.select("id", "title_hash", "_empty_key"), "title_hash", "id", "_later", exempt=F.col("_empty_key"))
    later = flagged.where("_later").groupBy(F.col("id").alias("_id")).agg(F.collect_set("title_hash").alias("_hashes"))
    base = base if documents is None else _articles(documents)
    both = base.join(later, base["id"] == later["_id"], "left") \
        .withColumn("is_duplicate", F.coalesce(F.array_contains("_hashes", F.col("title_hash")), F.lit(False)))
    return both.select("id", "url", "title", "title_hash", "body", "category", "source",
                          "published_at", "is_duplicate")


def label_sentiment(toxic: Column, quality: Column) -> Column:
    return F.when(toxic == 1, F.lit("negative")).when(quality == 1, F.lit("positive")).otherwise(F.lit("neutral"))


def summaries_view(spark: SparkSession, sf_dir: str, max_chars: int = K.SUMMARY_MAX_CHARS,
                   model: str = "mock", documents: DataFrame | None = None) -> DataFrame:
    """The summaries of all documents, or of ``documents``, some rows of the table."""
    docs = (read_table(spark, sf_dir, "documents") if documents is None else documents).select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    # made before the join, so whole texts do not move
    made = docs.select("doc_id", T.extractive_summary(F.col("text"), max_chars).alias("summary"), F.length("text").cast("long").alias("orig_len"))
    j = made.join(labels, "doc_id", "inner")
    s = j.select(
        F.col("doc_id").alias("article_id"), "summary", "orig_len",
        label_sentiment(F.col("toxic"), F.col("quality")).alias("sentiment"),
    )
    return s.select("article_id", "summary", "orig_len",
                    F.length("summary").cast("long").alias("summary_len"),
                    "sentiment", F.lit(model).alias("model"))


# --------------------------------------------------------------------------
# R / R+: raw rows from pages
# --------------------------------------------------------------------------
def spelled_day(day: Column, style: Column) -> Column:
    """The publication day written in one of five spellings (4 = missing)."""
    return (F.when(style == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00+09:00")))
            .when(style == 1, F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 10:00:00 +0900")))
            .when(style == 2, F.date_format(day, "yyyy.MM.dd"))
            .when(style == 3, F.date_format(day, "yyyy/MM/dd")))


def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    x = with_extracted(p).select("page_id", "url", F.struct("title", "body").alias("x"), "body_found")
    day = _day_of(F.col("page_id"))
    return x.select(
        F.col("page_id").alias("id"),
        url_host(F.col("url")).alias("source"),
        F.lit("rss+crawl").alias("method"),
        F.col("url").alias("guid"),
        F.col("url"),
        F.col("x.title").alias("title"),
        F.col("x.body").alias("body"),
        url_first_segment(F.col("url")).alias("category"),
        spelled_day(day, F.pmod(F.col("page_id"), F.lit(5))).alias("published_at"),
        F.when(F.col("body_found"), F.lit("ok")).otherwise(F.lit("failed")).alias("crawl_status"),
        F.concat(F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit("T09:00:00+09:00")).alias("collected_at"),
    )


#: Rows of R+ are numbered page id * VARIANTS + variant (0 the page itself, 1 a
#: copy, 2 moved, 3 broken), so ids never meet, however large page ids get.
VARIANTS = 4
#: Of so many pages each, four have a broken fetch beside the good one.
BROKEN_EVERY = 50


def is_original(raw_id: Column) -> Column:
    return F.pmod(raw_id, F.lit(VARIANTS)) == 0


def _with_param(url: Column, param: str) -> Column:
    """Insert ``param`` into the query part, before any fragment."""
    base = F.regexp_extract(url, r"^([^#]*)", 1)
    frag = F.regexp_extract(url, r"(#.*)$", 1)
    sep = F.when(base.contains("?"), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(base, sep, F.lit(param), frag)


def raw_plus_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R+ in one pass over R (pages are scanned and extracted once): each raw
    row is exploded into itself plus the variants that apply to it."""
    r = raw_view(spark, sf_dir)
    rid, broken = F.col("id"), F.pmod(F.col("id"), F.lit(BROKEN_EVERY))
    variants = F.filter(
        F.array(*[F.lit(i) for i in range(4)]),
        lambda k: (k == 0)
        | ((k == 1) & (F.pmod(rid, F.lit(5)) == 0))      # re-fetch through a tracking link, newer title
        | ((k == 2) & (F.pmod(rid, F.lit(7)) == 0))      # same story under another path
        | ((k == 3) & broken.between(1, 4)))              # broken fetches
    e = r.select("*", F.explode(variants).alias("_v"))
    v = F.col("_v")
    moved_url = F.concat(F.lit("https://"), F.col("source"), F.lit("/"), F.col("category"),
                         F.lit("/story-"), rid.cast("string"))
    out = {
        "id": rid * VARIANTS + v,
        "url": (F.when(v == 1, _with_param(F.col("url"), "utm_source=copy")).when(v == 2, moved_url)
                .when((v == 3) & (broken == 1), F.lit("")).otherwise(F.col("url"))),
        "title": (F.when(v == 1, F.concat(F.col("title"), F.lit(" v2")))
                  .when((v == 3) & (broken == 2), F.lit("")).otherwise(F.col("title"))),
        "body": (F.when((v == 3) & (broken == 3), F.lit("")).when((v == 3) & (broken == 4), F.substring("body", 1, 60))
                 .otherwise(F.col("body"))),
        "crawl_status": F.when((v == 3) & (broken == 3), F.lit("failed")).otherwise(F.col("crawl_status")),
    }
    return e.select(*[out[c].alias(c) if c in out else F.col(c) for c in r.columns])
