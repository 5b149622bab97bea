"""Keyed merges (M1-M5).

Parquet has no MERGE; each merge returns the next rows as a DataFrame (a join
on the key with per-column rules).  ``BucketStore.merge`` (store.py) applies it
to the buckets that a batch touches; ``write_snapshot`` writes a whole table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .clean import CLEAN_COLUMNS, similar_flag
from .dedup import first_per_key, last_per_key

# Columns an upsert replaces; ``id`` and ``is_duplicate`` stay (M1).
UPSERT_REPLACES = ("raw_id", "title", "body", "title_hash", "category", "source", "published_at")


def merge_clean(store: DataFrame, batch: DataFrame, policy: str = "skip",
                dedup_similar: bool = False, titles: DataFrame | None = None) -> DataFrame:
    """M1: next clean snapshot plus ``outcome`` per url; near duplicates are
    flagged with ``dedup_similar`` only.

    ``store``: id, is_duplicate + CLEAN_COLUMNS.  ``batch``: valid clean rows
    (CLEAN_COLUMNS).  skip = insert-or-ignore, upsert = last row of the
    batch replaces the stored columns except id and is_duplicate.  New rows
    take their first ``raw_id`` as id (a stable surrogate key that needs no
    global sequence).  ``store`` may be the part of the table that the batch's
    urls fall into; ``titles`` then gives the title hashes of all of it.
    """
    # decided on narrow rows; the bodies are joined once, to the rows that stay
    narrow = batch.select("url", "raw_id", "title_hash")
    first = first_per_key(narrow, "url", "raw_id")
    new_rows = first.join(store.select("url"), "url", "left_anti")
    if dedup_similar:
        new_rows = similar_flag(new_rows, store, titles)
    else:
        new_rows = new_rows.withColumn("is_duplicate", F.lit(False))
    inserted = batch.join(new_rows.select("raw_id", "is_duplicate"), "raw_id").dropDuplicates(["raw_id"]).select(
        F.col("raw_id").alias("id"), "is_duplicate", *CLEAN_COLUMNS, F.lit("inserted").alias("outcome"))
    if policy == "upsert":
        last = last_per_key(batch, "url", "raw_id")
        # a new url ends with its last batch row; id and flag of the first
        inserted = (inserted.select("url", "id", "is_duplicate", "outcome")
                    .join(last, "url").select("id", "is_duplicate", *CLEAN_COLUMNS, "outcome"))
        s = store.alias("s")
        b = last.alias("b")
        j = s.join(b, "url", "full_outer")
        in_store = F.col("s.id").isNotNull()
        in_batch = F.col("b.raw_id").isNotNull()
        cols = {"id": F.coalesce(F.col("s.id"), F.col("b.raw_id"))}
        for c in UPSERT_REPLACES:
            cols[c] = F.when(in_batch, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}"))
        j = j.where(in_store).select(
            cols["id"].alias("id"), F.col("s.is_duplicate").alias("is_duplicate"), F.col("url"),
            *[cols[c].alias(c) for c in UPSERT_REPLACES],
            F.when(in_batch, F.lit("updated")).otherwise(F.lit("kept")).alias("outcome"))
        kept = j.select("id", "is_duplicate", *CLEAN_COLUMNS, "outcome")
    else:
        kept = store.select("id", "is_duplicate", *CLEAN_COLUMNS, F.lit("kept").alias("outcome"))
    return kept.unionByName(inserted)


def merge_last_wins(store: DataFrame, batch: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """M2/M3/M5: replace-all merge; the batch row with the largest ``order``
    per key replaces the stored row."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = last_per_key(batch, keys, order)
    untouched = store.join(newest.select(*keys), keys, "left_anti")
    return untouched.unionByName(newest.select(*store.columns))


def write_snapshot(df: DataFrame, spark: SparkSession, name: str, partition_by: list[str] | None = None) -> str:
    """Write one immutable version under the shared checkpoint folder and
    return its path (the caller swaps its pointer afterwards)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}/v-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
