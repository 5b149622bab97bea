"""Read path: filtered article queries (P1-P9, P13, P14, P16), the summary
join (J1), article order (T1), paging (W9/T2) and export view (S10).

Filters are plain predicates on the scan, so Catalyst pushes them into the
Parquet reader; the summary join is an equi-join on the article id, made once
where the read table is stored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import cut_cell
from .ranking import RankedTable

ARTICLE_COLUMNS = ("id", "url", "title", "title_hash", "body", "category", "source", "published_at",
                   "is_duplicate")
SUMMARY_COLUMNS = ("summary", "sentiment", "orig_len", "summary_len")


def articles_joined(articles: DataFrame, summaries: DataFrame) -> DataFrame:
    """Articles LEFT OUTER summaries on id (P9 projection)."""
    s = summaries.select(F.col("article_id").alias("_sid"), *SUMMARY_COLUMNS)
    return articles.join(s, articles["id"] == s["_sid"], "left").select(
        *ARTICLE_COLUMNS, *SUMMARY_COLUMNS, F.col("_sid").isNotNull().alias("_summarized"))


def filter_articles(articles: DataFrame, *, article_id: int | None = None,
                    category: str | None = None, source: str | None = None, day: str | None = None,
                    date_from: str | None = None, date_to: str | None = None, keyword: str | None = None,
                    include_duplicates: bool = False) -> DataFrame:
    """P1-P8 without the summary status: ANDed predicates on the article
    columns, so they reach the scan; empty strings mean "no filter"."""
    a = articles
    if article_id is not None:
        a = a.where(F.col("id") == article_id)
    if category:
        a = a.where(F.col("category") == category)
    if source:
        a = a.where(F.col("source") == source)
    if day:
        a = a.where(F.col("published_at") == F.lit(day).cast("date"))
    if date_from:
        a = a.where(F.col("published_at") >= F.lit(date_from).cast("date"))
    if date_to:
        a = a.where(F.col("published_at") <= F.lit(date_to).cast("date"))
    if keyword:
        # '%' and '_' inside the keyword stay wildcards, a backslash is itself; only A-Z fold
        pat = "%" + keyword.translate(str.maketrans(ascii_uppercase, ascii_lowercase)).replace("\\", "\\\\") + "%"
        folded = [F.translate(c, ascii_uppercase, ascii_lowercase) for c in ("title", "body")]
        a = a.where(folded[0].like(pat) | folded[1].like(pat))
    if not include_duplicates:
        a = a.where(~F.col("is_duplicate"))
    return a


def _of_status(joined: DataFrame, status: str | None) -> DataFrame:
    if status == "summarized":
        joined = joined.where(F.col("_summarized"))
    elif status == "unsummarized":
        joined = joined.where(~F.col("_summarized"))
    return joined.drop("_summarized")


def query_articles(articles: DataFrame, summaries: DataFrame, *, status: str | None = None, **filters) -> DataFrame:
    """P1-P8 over articles and summaries apart: the article filters stay below
    the join.  Unordered — apply :func:`order_articles` (T1) where order matters."""
    return _of_status(articles_joined(filter_articles(articles, **filters), summaries), status)


# --------------------------------------------------------------------------
# the read table: articles with their summaries, clustered for P1-P8
# --------------------------------------------------------------------------
def write_article_table(articles: DataFrame, summaries: DataFrame, path: str) -> None:
    """Stores the read path's table: flags and summaries are decided once, days
    are folders, files are sorted by id (so their id ranges hardly overlap) and
    carry Bloom filters on id, url and title hash.  A day, a span of days or an
    id is then one pruned scan, without a join."""
    rows = articles_joined(articles, summaries)
    w = rows.repartitionByRange("published_at", "id").sortWithinPartitions("published_at", "id").write.mode("overwrite")
    for c in ("id", "url", "title_hash"):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.partitionBy("published_at").parquet(path)


def read_article_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*ARTICLE_COLUMNS[:7], F.col("published_at").cast("date"), "is_duplicate", *SUMMARY_COLUMNS, "_summarized")


def query_table(table: DataFrame, *, status: str | None = None, **filters) -> DataFrame:
    """P1-P8 over the stored read table."""
    return _of_status(filter_articles(table, **filters), status)


def newest_first() -> list[Column]:
    """Newest first, then id desc; NULL dates last."""
    return [F.col("published_at").desc_nulls_last(), F.col("id").desc()]


def order_articles(df: DataFrame) -> DataFrame:
    return df.orderBy(*newest_first())


def ranked_articles(df: DataFrame) -> RankedTable:
    """Articles in T1 order with an index of their ranks: any page of it
    (``page``) reads the ranges that it lies in, however deep it is."""
    return RankedTable(df, newest_first())


def article_page(df: DataFrame, page: int = 1, page_size: int = K.PAGE_SIZE) -> DataFrame:
    """Page ``page`` of ``page_size`` rows in T1 order with the total and
    last page; a page past the end is empty.  Inputs are clamped to >= 1.

    Ordered top-(offset+limit) runs as TakeOrderedAndProject (a bounded
    per-task heap), not a full sort; that suits the first pages.  For deep
    ones, or many, see :func:`ranked_articles`.
    """
    page = max(int(page), 1)
    page_size = max(int(page_size), 1)
    rows = order_articles(df).offset((page - 1) * page_size).limit(page_size)
    total = df.agg(F.count(F.lit(1)).alias("total"))
    last = F.floor((F.col("total") + page_size - 1) / page_size).cast("long")
    return rows.crossJoin(F.broadcast(total)).select(
        *df.columns, F.lit(page).cast("long").alias("page"), "total", last.alias("last_page"))


def article_detail(joined: DataFrame, article_id: int, preview_chars: int | None = None) -> DataFrame:
    """One article (duplicates included) with compression ratio and its
    body, or the first ``preview_chars`` of it."""
    a = joined.where(F.col("id") == article_id)
    ratio = F.when(F.col("summary").isNotNull() & (F.coalesce(F.col("orig_len"), F.lit(0)) != 0),
                   F.round(F.col("summary_len") / F.col("orig_len") * 100, 4)) \
        .when(F.col("summary").isNotNull(), F.lit(0.0))
    return a.select("id", "title", "source", "category", "published_at", "url", "is_duplicate",
                    F.length("body").cast("long").alias("body_len"), "summary", "sentiment",
                    ratio.alias("compression_pct"),
                    (F.col("body") if preview_chars is None else
                     F.when(F.length("body") <= preview_chars, F.col("body"))
                     .otherwise(F.concat(F.substring("body", 1, preview_chars), F.lit(" …")))).alias("preview"))


def summary_targets(articles: DataFrame, summaries: DataFrame, *, article_id: int | None = None,
                    category: str | None = None, all_: bool = False) -> DataFrame:
    """One id (duplicates allowed), all, or unsummarized (default)."""
    if article_id is not None:
        return query_articles(articles, summaries, article_id=article_id, include_duplicates=True)
    return query_articles(articles, summaries, category=category, status=None if all_ else "unsummarized")


def export_view(joined: DataFrame, cell_limit: int | None = None) -> DataFrame:
    """Export columns in file order, whole texts; with ``cell_limit``
    longer strings are cut and marked (for spreadsheet programs)."""
    out = []
    for key, _header in K.EXPORT_COLUMNS:
        c = F.col(key)
        if cell_limit and key in ("title", "url", "summary", "body", "source", "category", "sentiment"):
            c = cut_cell(c, cell_limit)
        out.append(c.alias(key))
    return joined.select(*out)


def export_csv(joined: DataFrame, path: str, cell_limit: int | None = None) -> None:
    """S10 sink: standard CSV (every cell quoted, quotes doubled, blanks kept)
    with the display headers, one file per task."""
    view = export_view(joined, cell_limit)
    view.select(*[F.col(k).alias(h) for k, h in K.EXPORT_COLUMNS]).write.mode("overwrite") \
        .options(header=True, quoteAll=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False).csv(path)
