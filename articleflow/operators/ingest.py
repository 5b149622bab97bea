"""Incremental ingest: seen/cursor filter (J3/J4), title query (P10), per
source budget (W4), cursor and seen-key state (W5/W6, M3), raw append rows
(S8), existence checks (J8) and the clean backlog (S9).

State is two tables: the feeds' cursors (source, category, last_pubdate as UTC
ISO text) and the seen keys as rows (source, category, guid, t = item time).
The seen check is an anti join on (source, category, guid), so no feed's
history is ever one row or one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .dedup import top_k_per_group

FEED_KEY = ["source", "category"]
SEEN_KEY = [*FEED_KEY, "guid"]


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


CURSORS = _strings(*FEED_KEY, "last_pubdate")
KEYS = _strings(*SEEN_KEY, "t")


class FeedState(NamedTuple):
    """Cursors (CURSORS, one row a feed) and seen keys (KEYS, one row a key)."""

    cursors: DataFrame
    keys: DataFrame


def apply_query(items: DataFrame, query: str | None) -> DataFrame:
    """P10: title contains the query, case-insensitive, no wildcards."""
    if not query:
        return items
    return items.where(F.instr(F.lower(F.col("title")), query.lower()) > 0)


def filter_new(items: DataFrame, state: FeedState | None, incremental: bool = True) -> DataFrame:
    """J3 + J4: drop items whose guid was seen for their feed, and items
    whose time is <= the feed cursor (both set; a NULL time passes)."""
    if not incremental or state is None:
        return items
    fresh = items.join(state.keys.select(*SEEN_KEY), SEEN_KEY, "left_anti")
    cur = state.cursors.select(*FEED_KEY, F.col("last_pubdate").alias("_cursor"))
    j = fresh.join(cur, FEED_KEY, "left")
    keep = F.col("_cursor").isNull() | F.col("published_at").isNull() | (F.col("published_at") > F.col("_cursor"))
    return j.where(keep).drop("_cursor")


def source_budget(items: DataFrame, feeds: DataFrame, limit: int | None = None) -> DataFrame:
    """The items of the feeds; with a ``limit``, at most that many per
    source, feeds in feed order, items in feed order (exact, skew-safe top-k
    per source).  Without one ``budget_rank`` is NULL."""
    j = items.join(feeds.select(*FEED_KEY, "feed_pos"), FEED_KEY)
    if limit is None:
        return j.withColumn("budget_rank", F.lit(None).cast("long"))
    order = [F.col("feed_pos"), F.col("feed_no"), F.col("item_pos"), F.col("guid")]
    return top_k_per_group(j, ["source"], order, limit, rank_col="budget_rank")


def next_cursors(kept: DataFrame, cursors: DataFrame | None, dropped: DataFrame | None = None) -> DataFrame:
    """The new cursors of the feeds that kept items: max(kept time), never
    below the old cursor.

    Without ``dropped`` the cursor moves to the newest *kept* item, which
    loses older new items that were left behind (as in the original).
    ``dropped`` (new items that were not kept, be it for a budget or for a
    title query) makes it lossless: the cursor only moves to kept times below
    the oldest dropped time, so those items pass the cursor check next time
    (kept items above it are still stopped by the seen keys)."""
    times = kept.select(*FEED_KEY, F.col("published_at").alias("t"))
    if dropped is not None:
        floor = dropped.where(F.col("published_at").isNotNull()).groupBy(*FEED_KEY) \
            .agg(F.min("published_at").alias("_floor"))
        below = F.col("_floor").isNull() | (F.col("t") < F.col("_floor"))
        times = times.join(floor, FEED_KEY, "left").select(*FEED_KEY, F.when(below, F.col("t")).alias("t"))
    touched = times.groupBy(*FEED_KEY).agg(F.max("t").alias("_newest"))
    if cursors is None:
        return touched.select(*FEED_KEY, F.col("_newest").alias("last_pubdate"))
    # greatest skips nulls: an old cursor or a new time alone stays
    return touched.join(cursors.select(*CURSORS.names), FEED_KEY, "left") \
        .select(*FEED_KEY, F.greatest("last_pubdate", "_newest").alias("last_pubdate"))


def new_keys(kept: DataFrame) -> DataFrame:
    """The seen keys that the kept items add, one row a key."""
    return kept.groupBy(*SEEN_KEY).agg(F.max("published_at").alias("t"))


def next_state(kept: DataFrame, state: FeedState | None, cap: int | None = None, dropped: DataFrame | None = None) -> FeedState:
    """W5 + W6 + M3 as whole tables: new cursors and keys for the feeds that
    kept items; other feeds keep theirs untouched.  Seen keys are old keys
    and kept guids; with a ``cap``, a touched feed keeps the newest by (kept
    now, time, guid)."""
    cursors, keys = next_cursors(kept, state.cursors if state else None, dropped), new_keys(kept).withColumn("_fresh", F.lit(1))
    if state is not None:
        untouched = state.cursors.join(cursors.select(*FEED_KEY), FEED_KEY, "left_anti")
        cursors = cursors.unionByName(untouched.select(*CURSORS.names))
        keys = keys.unionByName(state.keys.select(*KEYS.names, F.lit(0).alias("_fresh")))
        keys = keys.groupBy(*SEEN_KEY).agg(F.max("t").alias("t"), F.max("_fresh").alias("_fresh"))
    if cap is not None:
        newest = [F.col("_fresh").desc(), F.col("t").desc_nulls_last(), F.col("guid").desc()]
        hit = kept.select(*FEED_KEY).distinct()
        rest = keys.join(hit, FEED_KEY, "left_anti")
        keys = top_k_per_group(keys.join(hit, FEED_KEY, "left_semi"), FEED_KEY, newest, cap).select(*rest.columns).unionByName(rest)
    return FeedState(cursors, keys.select(*KEYS.names))


def raw_rows(kept: DataFrame, collected_at: str) -> DataFrame:
    """Rows appended to the raw table (partition column collected_date)."""
    return kept.select(
        "source", "method", "guid", "url", "title", "body", "category", "published_at", "crawl_status",
        "raw_json", F.lit(collected_at).alias("collected_at"),
        F.to_date(F.substring(F.lit(collected_at), 1, 10)).alias("collected_date"))


def guid_exists(items: DataFrame, raw: DataFrame) -> DataFrame:
    """Items whose (source, guid) already exists in raw."""
    return items.join(raw.select("source", "guid").distinct(), ["source", "guid"], "left_semi")


def uncleaned(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw rows not in the processed-id ledger, in id order."""
    return raw.join(processed.select(F.col("raw_id").alias("id")), "id", "left_anti")


def fetch_stats(feeds: DataFrame, items: DataFrame) -> DataFrame:
    """Per source and in total ('*'): feeds read and those without items
    (``feeds``: source, n_items), items saved and those whose body failed
    (``items``: source, crawl_status), in one aggregate over both."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = feeds.select("source", one.alias("feeds"), (F.col("n_items") == 0).cast("long").alias("feed_failed"), none.alias("saved"), none.alias("body_failed")) \
        .unionByName(items.select("source", none.alias("feeds"), none.alias("feed_failed"), one.alias("saved"),
                                  (F.col("crawl_status") == "failed").cast("long").alias("body_failed")))
    names = ("feeds", "feed_failed", "saved", "body_failed")
    sums = rows.rollup("source").agg(F.grouping("source").alias("__all"), *[F.sum(c).alias(c) for c in names])
    return sums.select(F.when(F.col("__all") == 1, "*").otherwise(F.col("source")).alias("source"), *names)
