"""Clean path: validation (P11/P12), url dedup (W1/W2), near-duplicate flag
(W3), clean-run outcome statistics (A9/A10).

Input is a raw frame with ``id, url, title, body, category, source,
published_at, collected_at``.  Rows are validated and normalised in one
projection; the dedup steps are aggregations on the url / title-hash keys
(see :mod:`articleflow.operators.dedup`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StringType, StructField, StructType

from .. import constants as K
from ..functions import text as T
from ..functions.dates import normalize_date
from ..functions.urls import normalize_url
from ..session import small_batches
from ..session import stage as stage_table
from .dedup import first_per_key, last_per_key

# sha1 of the empty title key: titles without ASCII alnum / Hangul.
EMPTY_TITLE_HASH = "da39a3ee5e6b4b0d3255bfef95601890afd80709"

CLEAN_COLUMNS = ("raw_id", "url", "title", "title_hash", "body", "category", "source", "published_at")
_TYPES = {"raw_id": LongType(), "published_at": DateType()}
#: Rows of the clean table, and of the ledger of processed raw rows.
STORED = StructType([StructField("id", LongType()), StructField("is_duplicate", BooleanType()),
                     *[StructField(c, _TYPES.get(c, StringType())) for c in CLEAN_COLUMNS]])
LEDGER = StructType([StructField("raw_id", LongType()), StructField("reason", StringType())])


def validate(raw: DataFrame, min_body: int = K.MIN_BODY, stage: bool = True) -> DataFrame:
    """Every raw row with ``reason`` ('ok' or the first failing rule),
    ``body_len`` and the normalised clean fields.

    With ``stage`` (default) the validated rows are written once as a table
    in the shared checkpoint folder: the text normalisation runs once per row, the
    later branches (valid / rejected / url firsts / title firsts) read the
    staged rows, and the lineage back to the raw scan is cut.
    """
    norm = small_batches(raw).select(
        F.col("id").alias("raw_id"),
        T.unicode_trim(F.coalesce(F.col("url"), F.lit(""))).alias("_url"),
        T.normalize_text(F.col("title"), strip_boilerplate_=False).alias("title"),
        T.normalize_text(F.col("body"), strip_boilerplate_=True).alias("body"),
        F.col("category"), F.col("source"), F.col("published_at").alias("_pub"), F.col("collected_at"),
    )
    reason = (F.when(F.col("_url") == "", F.lit("no_url"))
              .when(F.col("title") == "", F.lit("no_title"))
              .when(F.col("body") == "", F.lit("no_body"))
              .when(F.length("body") < min_body, F.lit("short_body"))
              .otherwise(F.lit("ok")))
    out = norm.select(
        "raw_id",
        reason.alias("reason"),
        F.length("body").cast("long").alias("body_len"),
        normalize_url(F.col("_url")).alias("url"),
        "title",
        T.title_hash(F.col("title")).alias("title_hash"),
        "body",
        F.coalesce(T.blank_to_null("category"), F.lit(K.DEFAULT_CATEGORY)).alias("category"),
        F.coalesce(T.blank_to_null("source"), F.lit(K.DEFAULT_SOURCE)).alias("source"),
        normalize_date(F.col("_pub"), F.col("collected_at")).alias("published_at"),
    )
    if stage:
        out = stage_table(out, "validated")
    return out


def clean_valid(raw: DataFrame, min_body: int = K.MIN_BODY) -> DataFrame:
    return validate(raw, min_body).where(F.col("reason") == "ok").select(*CLEAN_COLUMNS)


def clean_rejects(raw: DataFrame, min_body: int = K.MIN_BODY) -> DataFrame:
    """Reject-reason histogram; a short body is its own bucket per length."""
    v = validate(raw, min_body).where(F.col("reason") != "ok")
    return v.groupBy(
        "reason",
        F.when(F.col("reason") == "short_body", F.col("body_len")).alias("short_len"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _not_in_store(batch: DataFrame, store: DataFrame | None) -> DataFrame:
    if store is None:
        return batch
    return batch.join(store.select("url").distinct(), "url", "left_anti")


def dedup_skip(valid: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """First row per url in id order, minus urls already stored."""
    return first_per_key(_not_in_store(valid, store), "url", "raw_id")


def dedup_upsert(valid: DataFrame) -> DataFrame:
    """Last row per url wins; the id stays the first row's ``raw_id``."""
    last = last_per_key(valid, "url", "raw_id")
    first = valid.groupBy("url").agg(F.min("raw_id").alias("id"))
    return last.join(first, "url").select("id", *CLEAN_COLUMNS)


def similar_flag(winners: DataFrame, store: DataFrame | None = None, titles: DataFrame | None = None) -> DataFrame:
    """A new url is a near duplicate when an earlier non-duplicate row
    (stored, or earlier in this batch) has the same title hash.  The empty
    title key never flags (deliberate: all symbol-only titles would collide).
    ``titles`` (title_hash) may give the stored non-duplicates' hashes in place
    of the store.
    """
    firsts = winners.groupBy("title_hash").agg(F.min("raw_id").alias("_first"))
    out = winners.join(firsts, "title_hash", "left")
    cond = F.col("raw_id") != F.col("_first")
    if titles is None and store is not None:
        titles = store.where(~F.col("is_duplicate"))
    if titles is not None:
        held = titles.select("title_hash").distinct().withColumn("_held", F.lit(True))
        out = out.join(held, "title_hash", "left")
        cond = cond | F.coalesce(F.col("_held"), F.lit(False))
    cond = cond & (F.col("title_hash") != EMPTY_TITLE_HASH)
    return out.select(*winners.columns, cond.alias("is_duplicate"))


def clean_outcomes(raw: DataFrame, policy: str = "skip", min_body: int = K.MIN_BODY,
                   dedup_similar: bool = False, store: DataFrame | None = None) -> DataFrame:
    """Per raw row: ``outcome`` in inserted / updated / skipped / invalid and
    ``similar`` (a similar row is also inserted)."""
    v = validate(raw, min_body)
    bad = v.where(F.col("reason") != "ok").select("raw_id", F.lit("invalid").alias("outcome"),
                                                  F.lit(False).alias("similar"))
    ok = v.where(F.col("reason") == "ok").select(*CLEAN_COLUMNS)
    firsts = ok.groupBy("url").agg(F.min("raw_id").alias("_first"))
    tagged = ok.join(firsts, "url")
    if store is not None:
        stored = store.select("url").distinct().withColumn("_stored", F.lit(True))
        tagged = tagged.join(stored, "url", "left")
        in_store = F.coalesce(F.col("_stored"), F.lit(False))
    else:
        in_store = F.lit(False)
    is_first = F.col("raw_id") == F.col("_first")
    if policy == "upsert":
        outcome = F.when(is_first & ~in_store, F.lit("inserted")).otherwise(F.lit("updated"))
    else:
        outcome = F.when(is_first & ~in_store, F.lit("inserted")).otherwise(F.lit("skipped"))
    tagged = tagged.select(*CLEAN_COLUMNS, outcome.alias("outcome"))
    inserted = tagged.where(F.col("outcome") == "inserted").select(*CLEAN_COLUMNS)
    if dedup_similar:
        flags = similar_flag(inserted, store).select("raw_id", F.col("is_duplicate").alias("similar"))
    else:
        flags = inserted.select("raw_id", F.lit(False).alias("similar"))
    good = tagged.join(flags, "raw_id", "left").select(
        "raw_id", "outcome", F.coalesce(F.col("similar"), F.lit(False)).alias("similar"))
    return good.unionByName(bad)


def clean_stats(raw: DataFrame, policy: str = "skip", min_body: int = K.MIN_BODY,
                dedup_similar: bool = False, store: DataFrame | None = None) -> DataFrame:
    """A10: one row per outcome that occurs with its count, plus the 'similar'
    count, in one pass over the rows."""
    names = ("inserted", "updated", "skipped", "invalid")
    counts = clean_outcomes(raw, policy, min_body, dedup_similar, store).agg(
        *[F.count_if(F.col("outcome") == x).alias(x) for x in names], F.count_if("similar").alias("similar"))
    rows = F.array(*[F.struct(F.lit(x).alias("outcome"), F.col(x).alias("n")) for x in (*names, "similar")])
    return counts.select(F.explode(rows).alias("o")).select("o.*").where((F.col("n") > 0) | (F.col("outcome") == "similar"))
