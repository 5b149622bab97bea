"""Versioned keyed tables on plain Parquet: hash buckets and a manifest.

A store's rows are dealt into buckets by the hash of their key.  A version is a
manifest: which folders hold the rows of each bucket.  ``merge`` rewrites the
buckets that a change touches and keeps the folders of all others, ``append``
adds a folder to each bucket it touches, so the bytes written follow the
change, not the store.  ``lookup`` reads only what may hold given keys: each
folder's manifest row has a bitmap of its keys (32,768 bits by hash), so a batch
of new keys opens next to nothing, however long the history is.

Every write names its run and batch.  A version is complete when its manifest
folder has its ``_SUCCESS`` file.  A batch that is written again (after a lost
executor or driver) starts from the version before its own first attempt and
replaces it; a new run (a lost checkpoint, say) starts from the newest version,
so nothing older is hidden or overwritten.

The manifest has at most ``buckets * (FOLDERS + 1)`` rows; it is the only thing
that the driver reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Buckets of a new store; folders of a bucket from which an append compacts it.
BUCKETS, FOLDERS = 64, 8
BITS = 32768

_MANIFEST = "bucket int, folder string, bits binary, run string, batch long, buckets int"


@dataclass(frozen=True)
class Version:
    number: int
    run: str
    batch: int
    #: (bucket, folder, bits)
    parts: tuple


def filesystem(spark: SparkSession, path: str):
    """Hadoop path and its file system (local, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str, prefix: str, complete: bool = False) -> list[str]:
    """Names of the folders ``prefix...`` in a folder (only those with a
    ``_SUCCESS`` file, if ``complete``), without the prefix."""
    p, fs = filesystem(spark, path)
    if not fs.exists(p):
        return []
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith(prefix)]
    return [x.getName()[len(prefix):] for x in found if not complete or fs.exists(new(x, "_SUCCESS"))]


def run_id(spark: SparkSession, folder: str) -> str:
    """The name of the run that owns ``folder`` (a stream's checkpoint): made
    once and kept there, so it is a new one if the folder is lost."""
    p, fs = filesystem(spark, folder)
    found = children(spark, folder, "_run-")
    if found:
        return min(found)
    name = uuid.uuid4().hex
    fs.mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"_run-{name}"))
    return name


class BucketStore:
    """A keyed table under ``path`` with the columns of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, list(key)
        newest = self.version()
        self.buckets = self._declared(newest) if newest else buckets

    # -- versions ----------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(v) for v in children(self.spark, f"{self.path}/manifest", "v=", complete=True))

    def _rows(self, number: int) -> DataFrame:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/v={number}")

    def _declared(self, version: Version) -> int:
        return self._rows(version.number).first()["buckets"]

    def version(self, number: int | None = None) -> Version | None:
        """The newest version (or the one of that number)."""
        every = self.versions()
        if not every:
            return None
        number = every[-1] if number is None else number
        rows = self._rows(number).collect()
        parts = tuple((r["bucket"], r["folder"], bytes(r["bits"])) for r in rows if r["bucket"] is not None)
        return Version(number, rows[0]["run"], rows[0]["batch"], parts)

    def base(self, run: str, batch: int) -> Version | None:
        """The version that a batch starts from: the newest that is not its own
        earlier attempt."""
        for number in reversed(self.versions()):
            v = self.version(number)
            if (v.run, v.batch) != (run, batch):
                return v
        return None

    def done(self, run: str, batch: int) -> bool:
        v = self.version()
        return v is not None and (v.run, v.batch) == (run, batch)

    # -- reading -----------------------------------------------------------
    def _folders(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: Version | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a version (default: the newest), or of some buckets."""
        version = version or self.version()
        parts = version.parts if version else ()
        return self._folders([f for b, f, _ in parts if buckets is None or b in buckets])

    def _hash(self) -> Column:
        return F.xxhash64(*self.key)

    def bucket(self) -> Column:
        return F.pmod(self._hash(), F.lit(self.buckets)).cast("int")

    def _place(self) -> Column:
        return F.pmod(F.shiftright(self._hash(), 20), F.lit(BITS)).cast("int")

    def touched(self, rows: DataFrame) -> set[int]:
        """Buckets of the keys of ``rows`` (at most ``buckets`` numbers)."""
        return {r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect()}

    def candidates(self, rows: DataFrame, version: Version | None) -> list[str]:
        """Folders of a version that may hold a key of ``rows``."""
        if version is None or not version.parts:
            return []
        bitmap = self.spark.createDataFrame(list(version.parts), "bucket int, folder string, bits binary")
        places = rows.select(self.bucket().alias("bucket"), self._place().alias("at")).distinct()
        byte = F.conv(F.hex(F.expr("substring(bits, at div 8 + 1, 1)")), 16, 10).cast("int")
        hit = F.expr("shiftright(byte, at % 8)").bitwiseAND(1) == 1
        met = places.join(F.broadcast(bitmap), "bucket").withColumn("byte", byte).where(hit)    # at most buckets * (FOLDERS + 1) rows of 4 KB
        return sorted(r["folder"] for r in met.select("folder").distinct().collect())

    def lookup(self, rows: DataFrame, version: Version | None) -> DataFrame:
        """Rows of a version among which are all that share a key with ``rows``."""
        return self._folders(self.candidates(rows, version))

    # -- writing -----------------------------------------------------------
    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], run: str, batch: int) -> Version:
        """The next version: ``combine(stored, changes)`` for the buckets of the
        keys of ``changes``, all other buckets as they are."""
        base = self.base(run, batch)
        hit = self.touched(changes)
        old = self.read(base, hit) if base else self._folders([])
        kept = [p for p in base.parts if p[0] not in hit] if base else []
        return self._commit(base, kept, combine(old, changes), run, batch)

    def append(self, rows: DataFrame, run: str, batch: int) -> Version:
        """The next version: ``rows`` added.  Buckets that have come to FOLDERS
        folders are written as one."""
        base = self.base(run, batch)
        parts = list(base.parts) if base else []
        count: dict[int, int] = {}
        for b, _, _ in parts:
            count[b] = count.get(b, 0) + 1
        full = {b for b, n in count.items() if n >= FOLDERS}
        if full:
            rows = rows.select(*self.schema.names).unionByName(self.read(base, full))
        return self._commit(base, [p for p in parts if p[0] not in full], rows, run, batch)

    def _commit(self, base: Version | None, kept: list, rows: DataFrame, run: str, batch: int) -> Version:
        folder = f"data/run={run}/batch={batch}"
        out = rows.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.schema.names]).withColumn("__bucket", self.bucket())
        out.repartition("__bucket").sortWithinPartitions("__bucket", *self.key).write.mode("overwrite").partitionBy("__bucket") \
            .parquet(f"{self.path}/{folder}")
        written = {int(b): f"{folder}/__bucket={b}" for b in children(self.spark, f"{self.path}/{folder}", "__bucket=")}
        bits = F.expr(f"bitmap_construct_agg(at)")
        made = self.spark.createDataFrame(sorted(written.items()), "bucket int, folder string")
        if written:
            stored = self._folders(list(written.values())).select(self.bucket().alias("bucket"), self._place().alias("at"))
            made = made.join(stored.groupBy("bucket").agg(bits.alias("bits")), "bucket")
        else:
            made = made.withColumn("bits", F.lit(None).cast("binary"))
        before = self.spark.createDataFrame(kept, "bucket int, folder string, bits binary")
        every = made.unionByName(before)
        if not written and not kept:              # an empty version
            every = self.spark.createDataFrame([(None, None, None)], "bucket int, folder string, bits binary")
        number = (base.number if base else 0) + 1
        every = every.withColumn("run", F.lit(run)).withColumn("batch", F.lit(batch).cast("long")).withColumn("buckets", F.lit(self.buckets))
        every.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={number}")
        return self.version(number)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes data and manifests that only versions before the newest
        ``keep`` use; returns the folders removed."""
        numbers = self.versions()
        used = {f for n in numbers[-keep:] for _, f, _ in self.version(n).parts}
        gone = []
        for run in children(self.spark, f"{self.path}/data", "run="):
            for batch in children(self.spark, f"{self.path}/data/run={run}", "batch="):
                folder = f"data/run={run}/batch={batch}"
                gone += [x for b in children(self.spark, f"{self.path}/{folder}", "__bucket=") if (x := f"{folder}/__bucket={b}") not in used]
        gone += [f"manifest/v={n}" for n in numbers[:-keep]]
        for x in gone:
            p, fs = filesystem(self.spark, f"{self.path}/{x}")
            fs.delete(p, True)
        return gone


def append_rows(rows: DataFrame, path: str, run: str, batch: int, partition_by: list[str] | None = None) -> None:
    """The rows of one batch as a folder of their own, so that a batch that
    is written again replaces itself and no other."""
    w = rows.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path.rstrip('/')}/run={run}/batch={batch}")
