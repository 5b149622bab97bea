"""Spark session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at every scale.  Shuffle partition count is left to
# AQE coalescing: start high enough for the cluster, let AQE merge small ones.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for the few Python functions; text rows can be large.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "articleflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed)
    folder and is used as is; without it a cluster session fails here,
    because a machine-local folder would hide one executor's rows from the
    others.  Only a single-JVM session (``local[...]``) that leaves it unset
    gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    current = tempfile.mkdtemp(prefix="articleflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(current)
    return current


#: Bytes of an Arrow batch of texts or pages, and its rows.
TEXT_BATCH, TEXT_ROWS = 1 << 20, 500


def small_batches(df):
    """``df``, in a session whose Arrow batches are bounded by bytes: a Python
    worker then holds some MB of texts at a time, however many rows a task has."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH))
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return df


def stage(df, name: str = "stage"):
    """Materialise ``df`` once as a Parquet table in the shared checkpoint
    folder and return a DataFrame reading it: lineage is cut, every later
    branch reads the staged rows, and a lost executor only re-reads files.
    ``unstage`` removes the table when nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def unstage(df) -> None:
    """Delete the staged table that ``df`` (a result of ``stage``) reads."""
    spark = df.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/tables/"
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    jvm = spark._jvm
    for folder in folders:
        if "/tables/" in folder and folder.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
