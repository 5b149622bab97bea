"""The corpus pipeline: five stages over ``documents``.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads again as the next stage's docs.  All stages but the last return the
columns of documents (``n_chars`` follows the text); the last one returns the
mix, each document as often as it takes it, with the copy's number in ``copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.llm import decontaminate, line_dedup, mix, simhash, toxicity
from articleflow.llm.common import table
from articleflow.session import stage


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score reaches the threshold."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that are spread over many sources; every document stays."""
    out = line_dedup.line_dedup(docs)
    size = F.when(F.col("__n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.simhash_dedup(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the sources' target weights."""
    return mix.mix(docs).withColumnRenamed("__copy", "copy")


STAGES = [("toxicity", toxic_documents), ("line_dedup", boilerplate_lines), ("simhash", near_duplicates),
          ("decontamination", benchmark_leaks), ("mix", source_mix)]

#: SQL cannot express the trained classifier, the fingerprints and the
#: alignment; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
