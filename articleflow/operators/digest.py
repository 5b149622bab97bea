"""Analysis selection (P16), digest (A15), insight records (A16, F13, F14),
selection listing text (F12), summary production (P15, M2).

The analysis selection is every article of a filter, or its newest ``limit``;
its ordinals are exact ranks of a range-partitioned table, its listing is one
row an article, and its digest is made of hash aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import labels as L
from ..functions import text as T
from . import articles as AR

# FIXED VALUES: offline analysis texts ({} are filled in order).
# MOCK_IMPLICATION alone is a wording of this library.
MOCK_TAG = "[모의분석] "
MOCK_TREND_TOP = "'{}' 관련 보도가 가장 많이 나타남"
MOCK_TREND_CATEGORIES = "카테고리 분포: "
MOCK_COMMON = "공통점: {}건 모두 같은 조건(기간·카테고리)으로 수집됨"
MOCK_DIFF = "차이점: 언론사별 비중 — "
MOCK_IMPLICATION = "실제 시사점은 모델 분석을 켜면 생성됩니다."
COUNT_SUFFIX = "건"
INSIGHT_ARRAYS = ("trends", "keywords", "common_diff", "implications")


def selected_articles(articles: DataFrame, summaries: DataFrame, category: str | None = None,
                      date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The articles of a P16 selection without a limit, in no order."""
    return AR.query_articles(articles, summaries, category=category, date_from=date_from, date_to=date_to)


def analysis_selection(articles: DataFrame, summaries: DataFrame, category: str | None = None,
                       date_from: str | None = None, date_to: str | None = None,
                       limit: int | None = None) -> DataFrame:
    """Filter + T1 order, all rows or the newest ``limit``, numbered
    1..k in listing order."""
    q = selected_articles(articles, summaries, category, date_from, date_to)
    if limit is None:
        return AR.ranked_articles(q).ranked("ordinal")
    top = AR.order_articles(q).limit(limit)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("published_at").desc_nulls_last(), F.col("id").desc())   # <= limit rows
    return top.withColumn("ordinal", F.row_number().over(w).cast("long"))


def _counted(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def _ranked_list(df: DataFrame, name: str, k: int | None, with_counts: bool) -> DataFrame:
    """One row: the names by n desc, name asc (first k, cut before they are
    collected), as "name n" text when ``with_counts``."""
    if k is not None:
        df = df.orderBy(F.col("n").desc(), F.col(name)).limit(k)
    arr = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(name).alias("k"), F.col("n"))))
    if with_counts:
        out = F.transform(arr, lambda s: F.concat(s["k"], F.lit(" "), s["n"].cast("string")))
    else:
        out = F.transform(arr, lambda s: s["k"])
    return df.agg(out.alias("v"))


def insight_digest(selection: DataFrame, stopwords=K.STOPWORDS, n_keywords: int = 8,
                   n_categories: int = 3) -> DataFrame:
    """One row -- article count, top title keywords, top categories
    and all sources ("name count" texts)."""
    toks = selection.select(F.explode(T.keyword_tokens(F.col("title"), stopwords)).alias("token"))
    kw = _ranked_list(_counted(toks, F.col("token"), "token"), "token", n_keywords, False) \
        .withColumnRenamed("v", "keywords")
    cats = _ranked_list(_counted(selection, F.coalesce(F.col("category"), F.lit("None")), "category"), "category",
                        n_categories, True).withColumnRenamed("v", "top_categories")
    srcs = _ranked_list(_counted(selection, F.coalesce(F.col("source"), F.lit("None")), "source"), "source",
                        None, True).withColumnRenamed("v", "sources")
    n = selection.agg(F.count(F.lit(1)).alias("n_articles"))
    return n.crossJoin(kw).crossJoin(cats).crossJoin(srcs)


def _pairs_text(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda s: F.concat(s, F.lit(COUNT_SUFFIX))), ", ")


def insight_record(digest: DataFrame, category: str | None, date_from: str | None = None,
                   date_to: str | None = None, model: str = "mock") -> DataFrame:
    """The offline insight record of a digest; kept only when at least
    two of the four arrays are non-empty."""
    scope = category or K.ALL_SCOPE
    top = F.coalesce(F.col("keywords")[0], F.lit(scope))
    rec = digest.select(
        F.lit(date_from).cast("string").alias("date_from"), F.lit(date_to).cast("string").alias("date_to"),
        F.lit(category).cast("string").alias("category"), "n_articles",
        F.array(F.concat(F.lit(MOCK_TAG), F.format_string(MOCK_TREND_TOP.replace("{}", "%s"), top)),
                F.concat(F.lit(MOCK_TAG + MOCK_TREND_CATEGORIES), _pairs_text(F.col("top_categories"))))
        .alias("trends"),
        F.when(F.size("keywords") > 0, F.col("keywords")).otherwise(F.array(F.lit(scope))).alias("keywords"),
        F.array(F.concat(F.lit(MOCK_TAG), F.format_string(MOCK_COMMON.replace("{}", "%d"), F.col("n_articles"))),
                F.concat(F.lit(MOCK_TAG + MOCK_DIFF), _pairs_text(F.col("sources")))).alias("common_diff"),
        F.array(F.lit(MOCK_TAG + MOCK_IMPLICATION)).alias("implications"),
        F.lit(model).alias("model"))
    filled = reduce(lambda a, b: a + b, [(F.size(c) > 0).cast("int") for c in INSIGHT_ARRAYS])
    return rec.where(filled >= 2)


def as_list(df: DataFrame, name: str) -> Column:
    """column ``name`` as a list: NULL -> [], a scalar -> [its text], an
    array -> itself."""
    c = F.col(name)
    if not df.schema[name].dataType.typeName() == "array":
        c = F.when(c.isNotNull(), F.array(c.cast("string")))
    return F.coalesce(c.cast("array<string>"), F.array().cast("array<string>"))


def encode_arrays(df: DataFrame, cols=INSIGHT_ARRAYS) -> DataFrame:
    """F14 encode: arrays (F13: of lists, scalars or NULLs) stored as JSON text."""
    return df.select(*[F.to_json(as_list(df, c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def decode_arrays(df: DataFrame, cols=INSIGHT_ARRAYS) -> DataFrame:
    """F14 decode: JSON text -> ARRAY<STRING>; bad or missing JSON -> []."""
    out = []
    for c in df.columns:
        if c in cols:
            parsed = F.from_json(F.col(c), "array<string>", {"mode": "PERMISSIVE"})
            out.append(F.coalesce(parsed, F.array().cast("array<string>")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def latest_insight(insights: DataFrame) -> DataFrame:
    """The newest record by id (one row, via max_by)."""
    return insights.agg(F.max_by(F.struct(*insights.columns), F.col("id")).alias("r")).select("r.*")


def list_insights(insights: DataFrame, k: int = 10) -> DataFrame:
    """The newest ``k`` records (top-k by id)."""
    return insights.orderBy(F.col("id").desc()).limit(k)


def selection_lines(selection: DataFrame, body_chars: int | None = None) -> DataFrame:
    """the listing line (ordinal, line) of each article of a selection, with
    whole bodies or their first ``body_chars``."""
    body = F.coalesce(F.col("body"), F.lit(""))
    content = F.when(F.coalesce(F.col("summary"), F.lit("")) != "", F.col("summary")) \
        .otherwise(body if body_chars is None else F.substring(body, 1, body_chars))
    line = F.concat(F.col("ordinal").cast("string"), F.lit(". ("),
                    F.coalesce(F.col("published_at").cast("string"), F.lit("None")), F.lit(" / "),
                    F.coalesce(F.col("source"), F.lit("None")), F.lit(" / "),
                    F.coalesce(F.col("category"), F.lit("None")), F.lit(") "), F.coalesce(F.col("title"), F.lit("")),
                    F.lit("\n   "), content)
    return selection.select("ordinal", line.alias("line"))


def selection_text(selection: DataFrame, body_chars: int | None = None) -> DataFrame:
    """the lines of a selection with a limit as one text."""
    lines = selection_lines(selection, body_chars).select(F.struct("ordinal", F.col("line").alias("l")).alias("x"))
    return lines.agg(F.array_join(F.array_sort(F.collect_list("x")).getField("l"), "\n").alias("text"),
                     F.count(F.lit(1)).alias("n_articles"))


# --------------------------------------------------------------------------
# P15 / M2 summaries
# --------------------------------------------------------------------------
def build_summaries(targets: DataFrame, max_chars: int = K.SUMMARY_MAX_CHARS, sentiment: bool = True,
                    model: str = "mock") -> DataFrame:
    """Offline summary + lexicon label per target; an empty summary is
    rejected.  Lengths are in characters of the full body."""
    s = targets.select(
        F.col("id").alias("article_id"),
        T.extractive_summary(F.col("body"), max_chars).alias("summary"),
        F.length("body").cast("long").alias("orig_len"),
        (L.lexicon_sentiment(F.concat(F.col("title"), F.col("body"))) if sentiment
         else F.lit(None).cast("string")).alias("sentiment"))
    return s.where(F.length(T.unicode_trim(F.col("summary"))) > 0).select(
        "article_id", "summary", "orig_len", F.length("summary").cast("long").alias("summary_len"), "sentiment",
        F.lit(model).alias("model"))


def summary_outcomes(targets: DataFrame, summaries: DataFrame, max_chars: int = K.SUMMARY_MAX_CHARS) -> DataFrame:
    """P15 outcome counts of a run over ``targets`` in one pass over them: ok
    (written), failed (empty summary) and done (had a summary before)."""
    before = summaries.select(F.col("article_id").alias("__sid"), F.lit(True).alias("__done")).distinct()
    t = targets.join(before, targets["id"] == F.col("__sid"), "left")
    text = T.extractive_summary(F.col("body"), max_chars)
    outcome = F.when(F.col("__done"), "done").when(F.length(T.unicode_trim(text)) > 0, "ok").otherwise("failed")
    counts = t.agg(*[F.count_if(outcome == x).alias(x) for x in ("ok", "failed", "done")])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(x).alias("outcome"), F.col(x).alias("n")) for x in ("ok", "failed", "done")]))
                         .alias("o")).select("o.*")
