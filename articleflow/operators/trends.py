"""Keyword statistics: top keywords (A12), keyword x day counts (A13), the
trend window (W7), the daily briefing (A14) and the keyword timeline (J9).

Token counting is explode + hash aggregate (partial aggregation combines a
hot token map-side).  Global orderings only run over small frames: the list
of distinct days (bounded by the calendar) and top-k results
(TakeOrderedAndProject keeps a k-row heap per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import keyword_tokens


def _visible(articles: DataFrame) -> DataFrame:
    return articles.where(~F.col("is_duplicate"))


def title_tokens(articles: DataFrame, stopwords=K.STOPWORDS) -> DataFrame:
    """(id, published_at, token) for every keyword token of every title."""
    return articles.select("id", "published_at",
                           F.explode(keyword_tokens(F.col("title"), stopwords)).alias("token"))


def top_keywords(articles: DataFrame, top_n: int = K.TOP_N, stopwords=K.STOPWORDS) -> DataFrame:
    """A12 + T3: the ``top_n`` most frequent title keywords of visible articles."""
    counts = title_tokens(_visible(articles), stopwords).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("token").asc()).limit(top_n)


def day_token_counts(articles: DataFrame, stopwords=K.STOPWORDS) -> DataFrame:
    """(day, token, n) for visible, dated articles over all days; an article
    without tokens contributes a (day, NULL) row, so every day with data
    appears.  One pass over the articles feeds the window and the counts
    (the identical exchanges are reused within a query)."""
    vis = _visible(articles).where(F.col("published_at").isNotNull())
    toks = vis.select(F.col("published_at").alias("day"),
                      F.explode_outer(keyword_tokens(F.col("title"), stopwords)).alias("token"))
    return toks.groupBy("day", "token").agg(F.count(F.lit(1)).alias("n"))


def _window_of(counts: DataFrame, days: int) -> DataFrame:
    w = Window.orderBy(F.col("day").desc())   # over distinct days only: tiny
    d = counts.select("day").distinct().withColumn("pos", F.row_number().over(w).cast("long"))
    if days > 0:
        d = d.where(F.col("pos") <= days)
    return d


def data_days(articles: DataFrame) -> DataFrame:
    """Distinct days with visible, dated articles (one row per day)."""
    return _visible(articles).where(F.col("published_at").isNotNull()).select(
        F.col("published_at").alias("day")).distinct()


def trend_window(articles: DataFrame, days: int = K.TREND_DAYS) -> DataFrame:
    """The last ``days`` distinct days with data (0 or negative = all),
    numbered from the newest (``pos`` 1 = "today")."""
    w = Window.orderBy(F.col("day").desc())   # over distinct days only: tiny
    d = data_days(articles).withColumn("pos", F.row_number().over(w).cast("long"))
    if days > 0:
        d = d.where(F.col("pos") <= days)
    return d


def _daily(counts: DataFrame, win: DataFrame) -> DataFrame:
    return counts.where(F.col("token").isNotNull()).join(win.select("day"), "day", "left_semi")


def daily_keywords(articles: DataFrame, days: int = K.TREND_DAYS, stopwords=K.STOPWORDS) -> DataFrame:
    """(day, token, n) inside the trend window."""
    counts = day_token_counts(articles, stopwords)
    return _daily(counts, _window_of(counts, days)).select("day", "token", "n")


def briefing_counts(articles: DataFrame, days: int = K.TREND_DAYS, stopwords=K.STOPWORDS) -> DataFrame:
    """Per token: today's count, pooled prior count and the prior mean."""
    counts = day_token_counts(articles, stopwords)
    win = _window_of(counts, days)
    meta = win.agg(F.max("day").alias("today"), F.count(F.lit(1)).alias("n_days"))
    per_day = _daily(counts, win)
    j = per_day.crossJoin(F.broadcast(meta))   # one-row frame
    agg = j.groupBy("token").agg(
        F.sum(F.when(F.col("day") == F.col("today"), F.col("n")).otherwise(0)).cast("long").alias("today_n"),
        F.sum(F.when(F.col("day") < F.col("today"), F.col("n")).otherwise(0)).cast("long").alias("prior_total"),
        F.first("n_days").alias("n_days"), F.first("today").alias("today"))
    prior_days = F.greatest(F.col("n_days") - 1, F.lit(1)).cast("long")
    return agg.select("today", "token", "today_n", "prior_total", prior_days.alias("prior_days"),
                      (F.col("prior_total") / prior_days).alias("prior_avg"))


def _top(df: DataFrame, top_n: int) -> DataFrame:
    return df.orderBy(F.col("today_n").desc(), F.col("token").asc()).limit(top_n)


def trend_top_today(articles: DataFrame, days: int = K.TREND_DAYS, top_n: int = K.TOP_N,
                    stopwords=K.STOPWORDS) -> DataFrame:
    b = briefing_counts(articles, days, stopwords).where(F.col("today_n") > 0)
    return _top(b, top_n).select("today", "token", "today_n")


def new_keywords(briefing: DataFrame) -> DataFrame:
    """A14 new: today >= 2 and never in the prior days."""
    return briefing.where((F.col("today_n") >= 2) & (F.col("prior_total") == 0))


def rising_keywords(briefing: DataFrame) -> DataFrame:
    """A14 rising: today >= 2, seen before, today >= 1.5 x prior mean and
    today - prior mean >= 1."""
    return briefing.where((F.col("today_n") >= 2) & (F.col("prior_total") > 0)
                          & (F.col("today_n") >= F.col("prior_avg") * 1.5)
                          & ((F.col("today_n") - F.col("prior_avg")) >= 1))


def trend_new(articles: DataFrame, days: int = K.TREND_DAYS, top_n: int = K.TOP_N,
              stopwords=K.STOPWORDS) -> DataFrame:
    """The most frequent new keywords."""
    return _top(new_keywords(briefing_counts(articles, days, stopwords)), top_n).select("today", "token", "today_n")


def trend_rising(articles: DataFrame, days: int = K.TREND_DAYS, top_n: int = K.TOP_N,
                 stopwords=K.STOPWORDS) -> DataFrame:
    """The most frequent rising keywords.  The mean is published unrounded."""
    b = rising_keywords(briefing_counts(articles, days, stopwords))
    return _top(b, top_n).select("today", "token", "today_n", "prior_total", "prior_days",
                                 F.round("prior_avg", 6).alias("prior_avg"))


def keyword_timeline(articles: DataFrame, days: int = K.TREND_DAYS, top_k: int = 6,
                     stopwords=K.STOPWORDS) -> DataFrame:
    """Window days x top-k keywords of the window, 0 where absent.  Both
    sides are bounded by parameters, so the grid is a broadcast cross join."""
    counts = day_token_counts(articles, stopwords)
    win = _window_of(counts, days)
    per_day = _daily(counts, win)
    top = (per_day.groupBy("token").agg(F.sum("n").alias("total"))
           .orderBy(F.col("total").desc(), F.col("token").asc()).limit(top_k).select("token"))
    grid = win.select("day").crossJoin(F.broadcast(top))
    return grid.join(per_day, ["day", "token"], "left").select(
        "day", "token", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
