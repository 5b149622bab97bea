"""Mixing sources to target weights.

Method: aggregate tokens per source, derive repetition rates, then emit each
document floor(rate) times plus one hash-seeded Bernoulli copy with
probability equal to the fraction.

A document's size is its number of words.  Sources in code-point order (null
last) get the weights in turn.  All targets together are ``budget`` times all
sizes; a target stops at ``max_rate`` times its source's size and the excess
goes to the other sources by weight, until no target is above its limit (or
all are at it).

JVM-side throughout.  The only wide steps are the per-source sum (combined
map-side, so a hot source is one row per task) and a join with the table of
rates, which Spark broadcasts only if its measured size allows.  A source's
place in the order comes from a range partitioning (a count per range plus the
place in the range), so no task ever holds all sources.  The excess is
reshared by aggregates over the source table; each round caps at least one
more source, and three numbers reach the driver.

Defined cases: a null text has size 0; a source of size 0 has target 0; the
null source is a source of its own; the coin depends on doc_id and seed only,
so reruns agree and repeated rows take the same decision; a null doc_id has a
coin of its own; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import WORD, table, word_count

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_RATE = 2
SEED = "mix-1"


def _source_places(sizes: DataFrame) -> DataFrame:
    """Adds ``__n``: the place of a source in code-point order, null last."""
    order = (F.col("__s").isNull(), F.col("__s"))
    ranged = stage(sizes.repartitionByRange(*order).withColumn("__r", F.spark_partition_id()), "mix-sources")
    before = ranged.groupBy("__r").agg(F.count(F.lit(1)).alias("c"))
    before = before.withColumn("__o", F.sum("c").over(Window.orderBy("__r")) - F.col("c")).select("__r", "__o")
    inside = F.row_number().over(Window.partitionBy("__r").orderBy(*order)) - 1
    return ranged.withColumn("__i", inside).join(before, "__r").withColumn("__n", F.col("__o") + F.col("__i"))


def source_targets(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_rate: int = MAX_RATE) -> DataFrame:
    """(__s, source_size, target, rate) from rows of (__s, __size)."""
    sizes = sized.groupBy("__s").agg(F.sum("__size").alias("source_size"))
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.col("__n") % len(weights)).cast("int")]
    src = stage(_source_places(sizes).select("__s", "source_size", weight.alias("w"),
                                             (F.col("source_size") * max_rate).alias("limit")), "mix-weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = (F.col("limit") <= F.col("w") * F.lit(level)) if capped >= 0 else F.lit(False)
        n, held, free = src.agg(F.sum(above.cast("int")), F.sum(F.when(above, F.col("limit")).otherwise(0)),
                                F.sum(F.when(above, 0.0).otherwise(F.col("w")))).first()
        if not n and capped >= 0 or n == capped or not free:
            break
        level, capped = (budget * total - held) / free, n
    above = F.col("limit") <= F.col("w") * F.lit(level)
    if capped >= 0 and not free:
        above = F.lit(True)
    target = F.when(above, F.col("limit").cast("double")).otherwise(F.col("w") * F.lit(level))
    return src.select("__s", "source_size", target.alias("target"),
                      F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def coin(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from 52 bits of the md5 of doc_id and seed."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix_rates(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) plus ``__size``, ``__source_size``,
    ``__target`` and ``__copies`` (how often the mix holds the document)."""
    sized = docs.withColumn("__size", word_count(F.col("text")))
    rates = stage(source_targets(sized.select(F.col("source").alias("__s"), "__size"), weights, budget, max_rate), "mix-rates")
    rates = rates.select("__s", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                         F.col("rate").alias("__rate"))
    whole = F.floor("__rate")
    copies = whole + (coin(F.col("doc_id"), seed) < F.col("__rate") - whole).cast("long")
    return sized.join(rates, F.col("source").eqNullSafe(F.col("__s"))) \
        .withColumn("__copies", copies.cast("long")).drop("__s", "__rate")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: ``docs`` with each document repeated ``__copies`` times
    and its number among them in ``__copy`` (from 1)."""
    out = mix_rates(docs, **how).where(F.col("__copies") > 0)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))) \
        .select(*docs.columns, "__copy")


def op4_mix(spark, sf_dir):
    """doc_id, size, source_size, target, taken of every document."""
    out = mix_rates(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


def sql(documents: str = "documents") -> str:
    """Rates in SQL: sources fill up in the order of limit per unit of weight."""
    weights = "[" + ", ".join(f"{w}.0" for w in WEIGHTS) + "]"
    return f"""
sized AS (SELECT *, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM {documents}),
src AS (SELECT source, sum(size)::BIGINT AS source_size,
  {weights}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}]::DOUBLE AS w FROM sized GROUP BY source),
run AS (SELECT *, {MAX_RATE} * source_size AS cap, {BUDGET} * (sum(source_size) OVER ())::DOUBLE AS total,
  sum({MAX_RATE} * source_size) OVER f - {MAX_RATE} * source_size AS held, sum(w) OVER () - sum(w) OVER f + w AS free
  FROM src WINDOW f AS (ORDER BY {MAX_RATE} * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
lvl AS (SELECT *, (total - held::DOUBLE) / free AS level FROM run),
pick AS (SELECT level FROM lvl WHERE cap > w * level ORDER BY cap / w, source NULLS LAST LIMIT 1),
tgt AS (SELECT source, source_size, CASE WHEN cap <= w * coalesce((SELECT level FROM pick), 1e300) THEN cap::DOUBLE
  ELSE w * (SELECT level FROM pick) END AS target FROM run),
rate AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r FROM tgt),
mixed AS (SELECT sized.*, source_size, target, floor(r)::BIGINT
  + (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{SEED}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < r - floor(r))::BIGINT AS copies
  FROM sized JOIN rate ON rate.source IS NOT DISTINCT FROM sized.source)"""


SQL = f"WITH {sql()} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"
