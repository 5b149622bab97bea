"""Structured Streaming jobs.

All jobs use a file source (a landing directory that an outside fetcher
fills), ``trigger(availableNow=True)`` for catch-up runs (the same code runs
continuously with a processing-time trigger), a checkpoint under the shared
checkpoint folder, and ``foreachBatch`` sinks whose writes are keyed by run and
epoch and overwrite that epoch's output, so a retried epoch after an
executor or driver loss never duplicates rows.  The run is a name kept in the
checkpoint folder: if that is lost, a new run goes on from the newest tables
under a name of its own, and reads old files again without effect.

State is kept in bucketed stores (operators/store.py): an epoch reads and
writes what its own keys touch, whatever the history holds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as K
from ..operators import clean as C
from ..operators import ingest as IN
from ..operators import merge as M
from ..operators.store import BucketStore, append_rows, run_id
from ..session import checkpoint_dir, stage, unstage
from ..sources import feeds as FD


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}/{uuid.uuid4().hex}"


def _source(spark: SparkSession, directory: str, schema: StructType, glob: str | None = None,
            max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


# --------------------------------------------------------------------------
# X5 daily counts
# --------------------------------------------------------------------------
def daily_counts_stream(spark: SparkSession, directory: str, schema: StructType, out: str,
                        glob: str | None = None, key: str = "event_type", ts: str = "ts",
                        delay: str = "1 day") -> None:
    """Count rows per (1-day event-time window, key).  The event time is
    cast to TIMESTAMP (a watermark needs it).  ``complete`` output: the
    state is one row per (day, key), bounded by the calendar."""
    s = _source(spark, directory, schema, glob).withColumn(ts, F.col(ts).cast("timestamp"))
    agg = (s.withWatermark(ts, delay)
           .groupBy(F.window(ts, "1 day").alias("w"), key)
           .agg(F.count(F.lit(1)).alias("n")))

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.select(F.col("w.start").cast("date").alias("day"), key, "n") \
            .write.mode("overwrite").parquet(out)

    q = (agg.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", out + "._ckpt").trigger(availableNow=True).start())
    q.awaitTermination()


# --------------------------------------------------------------------------
# X1 incremental ingest
# --------------------------------------------------------------------------
def feed_stores(spark: SparkSession, state_dir: str) -> tuple[BucketStore, BucketStore]:
    """The stores of the feeds' cursors and of their seen keys."""
    return (BucketStore(spark, f"{state_dir}/cursors", IN.CURSORS, IN.FEED_KEY),
            BucketStore(spark, f"{state_dir}/keys", IN.KEYS, IN.SEEN_KEY))


def _replace(key: list[str]):
    """The merge in which a key's new row replaces its old one."""
    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.join(new.select(*key), key, "left_anti").unionByName(new.select(*old.columns))
    return combine


def ingest_stream(spark: SparkSession, payload_dir: str, payload_schema: StructType, feeds: DataFrame,
                  state_dir: str, raw_dir: str, pages: DataFrame | None = None,
                  limit: int | None = None, query: str | None = None, incremental: bool = True,
                  collected_at: str = "1970-01-01T00:00:00+00:00", max_files: int | None = None,
                  lossless: bool = True) -> None:
    """Payload files -> S1 parse -> J3/J4 seen+cursor filter -> P10 query
    -> W4 budget -> S7 extraction outcome -> S8 raw append and W5/W6/M3 next
    state, once per micro-batch.

    With ``incremental`` off every item is accepted but the state still
    advances.  Every new item is taken unless ``limit`` is given; then
    ``lossless`` keeps the cursor below new items that the budget or the title
    query left behind, so a later batch still takes them.  Raw rows are written
    per run and epoch, partitioned by ``collected_date``; only the seen keys'
    folders that may hold one of the batch's keys are read."""
    def run_batch(batch: DataFrame, epoch: int) -> None:
        cursors, keys = feed_stores(spark, state_dir)
        before, known = cursors.base(run, epoch), keys.base(run, epoch)
        items = stage(FD.parse_feed(batch), "ingest-items")
        state = IN.FeedState(cursors.read(before, cursors.touched(items)), keys.lookup(items, known)) if before else None
        fresh = IN.filter_new(items, state, incremental)
        kept = stage(IN.source_budget(IN.apply_query(fresh, query), feeds, limit), "ingest-kept")
        append_rows(IN.raw_rows(FD.crawl_outcome(kept, pages), collected_at), raw_dir, run, epoch, ["collected_date"])
        dropped = fresh.join(kept.select(*IN.SEEN_KEY), IN.SEEN_KEY, "left_anti") \
            if lossless and (limit is not None or query) else None
        added = IN.new_keys(kept)
        if state:
            added = added.join(state.keys.select(*IN.SEEN_KEY), IN.SEEN_KEY, "left_anti")
        keys.append(added, run, epoch)
        cursors.merge(IN.next_cursors(kept, state.cursors if state else None, dropped), _replace(IN.FEED_KEY), run, epoch)
        unstage(items)
        unstage(kept)

    checkpoint_dir(spark)
    run = run_id(spark, state_dir + "._ckpt")
    src = _source(spark, payload_dir, payload_schema, max_files=max_files)
    q = (src.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", state_dir + "._ckpt").trigger(availableNow=True).start())
    q.awaitTermination()


# --------------------------------------------------------------------------
# X2 dedup
# --------------------------------------------------------------------------
def dedup_stream(spark: SparkSession, item_dir: str, schema: StructType, out: str,
                 keys=("source", "guid"), max_files: int | None = None) -> None:
    """Drop repeated (source, guid), however late (NULL keys are equal).
    The keys that were let through are a store beside ``out``; a batch is
    joined with the folders that may hold one of its keys."""
    def run_batch(batch: DataFrame, epoch: int) -> None:
        store = BucketStore(spark, out + "._keys", StructType([schema[k] for k in keys]), list(keys))
        fresh = batch.dropDuplicates(list(keys))
        seen = store.lookup(fresh, store.base(run, epoch)).select(*[F.col(k).alias(f"_{k}") for k in keys])
        fresh = stage(fresh.join(seen, [fresh[k].eqNullSafe(seen[f"_{k}"]) for k in keys], "left_anti"), "dedup-fresh")
        append_rows(fresh, out, run, epoch)
        store.append(fresh, run, epoch)
        unstage(fresh)

    checkpoint_dir(spark)
    run = run_id(spark, out + "._ckpt")
    src = _source(spark, item_dir, schema, max_files=max_files)
    q = (src.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", out + "._ckpt").trigger(availableNow=True).start())
    q.awaitTermination()


# --------------------------------------------------------------------------
# X4 incremental cleaning
# --------------------------------------------------------------------------
def clean_store(spark: SparkSession, clean_dir: str) -> BucketStore:
    """The clean table: id, is_duplicate and CLEAN_COLUMNS, a row for each url."""
    return BucketStore(spark, f"{clean_dir}/rows", C.STORED, ["url"])


def title_store(spark: SparkSession, clean_dir: str) -> BucketStore:
    """The title hash and id of the clean table's rows that are no duplicates."""
    return BucketStore(spark, f"{clean_dir}/titles", StructType([C.STORED["title_hash"], C.STORED["id"]]), ["title_hash"])


def ledger_store(spark: SparkSession, clean_dir: str) -> BucketStore:
    """The raw rows that were processed: raw_id and the reason (``ok`` or why
    the row was rejected)."""
    return BucketStore(spark, f"{clean_dir}/processed", C.LEDGER, ["raw_id"])


def clean_stream(spark: SparkSession, raw_dir: str, raw_schema: StructType, clean_dir: str,
                 policy: str = "skip", min_body: int = K.MIN_BODY, max_files: int | None = None,
                 dedup_similar: bool = False) -> None:
    """New raw rows -> validate -> merge into the clean table, and their ids
    into the ledger of processed rows.  An epoch rewrites the buckets of the
    clean table that its urls fall into, and looks up its title hashes; rows
    that an earlier epoch has processed are left out."""
    def run_batch(batch: DataFrame, epoch: int) -> None:
        store, titles, ledger = clean_store(spark, clean_dir), title_store(spark, clean_dir), ledger_store(spark, clean_dir)
        done = ledger.lookup(batch.select(F.col("id").alias("raw_id")), ledger.base(run, epoch)).select("raw_id")
        checked = C.validate(batch.join(done, batch["id"] == done["raw_id"], "left_anti"), min_body)
        valid = checked.where(F.col("reason") == "ok").select(*C.CLEAN_COLUMNS)
        held = stage(titles.lookup(valid, titles.base(run, epoch)), "clean-titles")
        plain = F.col("is_duplicate") == F.lit(False)
        parts = []

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            merged = M.merge_clean(old, new, policy, dedup_similar, titles=held)
            told = stage(merged.where(F.col("outcome") != "kept").select("id", "title_hash", "is_duplicate", "outcome"), "clean-outcomes")
            after = told.where(plain).select("title_hash", "id")
            before = old.join(told.where(F.col("outcome") == "updated").select("id"), "id", "left_semi").where(plain).select("title_hash", "id")
            parts.extend([told, after, before])
            return merged
        store.merge(valid, combine, run, epoch)
        told, after, before = parts
        if policy == "upsert":                  # an updated row may give up its title
            changes = after.exceptAll(before).withColumn("gone", F.lit(False)).unionByName(before.exceptAll(after).withColumn("gone", F.lit(True)))
            changes = stage(changes, "clean-title-changes")
            titles.merge(changes, lambda old, new: old.join(new.where("gone"), ["title_hash", "id"], "left_anti")
                         .unionByName(new.where("NOT gone").drop("gone")), run, epoch)
            unstage(changes)
        else:
            titles.append(after, run, epoch)
        ledger.append(checked.select("raw_id", "reason"), run, epoch)
        for used in (held, told, checked):
            unstage(used)

    checkpoint_dir(spark)
    run = run_id(spark, clean_dir + "._ckpt")
    src = _source(spark, raw_dir, raw_schema, max_files=max_files)
    q = (src.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", clean_dir + "._ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
