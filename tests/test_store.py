"""Bucketed snapshots: bytes follow the change, retries replace themselves, a
lost checkpoint hides nothing."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from articleflow.operators.merge import merge_last_wins
from articleflow.operators.store import FOLDERS, BucketStore, append_rows, children, run_id

SCHEMA = StructType([StructField("k", LongType()), StructField("name", StringType()), StructField("v", LongType())])


def make(spark, path, buckets=16):
    return BucketStore(spark, str(path), SCHEMA, ["k"], buckets)


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def content(store, version=None):
    return sorted(map(tuple, store.read(version).collect()))


def last(old, new):
    return merge_last_wins(old, new, "k", "v")


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    store = make(spark, tmp_path)
    first = store.merge(rows(spark, [(i, f"n{i}", 0) for i in range(400)]), last, "r", 0)
    assert len(first.parts) == 16
    second = store.merge(rows(spark, [(7, "new", 1), (10 ** 6, "more", 1)]), last, "r", 1)
    changed = {b for b, f, _ in second.parts if "batch=1" in f}
    assert len(changed) <= 2 and len(second.parts) == 16
    size = {b: sum(os.path.getsize(os.path.join(d, x)) for d, _, fs in os.walk(tmp_path / f"data/run=r/batch={b}") for x in fs) for b in (0, 1)}
    assert size[1] < size[0] / 3
    want = sorted([(i, f"n{i}", 0) for i in range(400) if i != 7] + [(7, "new", 1), (10 ** 6, "more", 1)])
    assert content(store) == want and content(store, first) == [(i, f"n{i}", 0) for i in range(400)]
    assert make(spark, tmp_path, 99).buckets == 16                 # a store keeps its number of buckets


def test_retry_replaces_its_own_attempt(spark, tmp_path):
    store = make(spark, tmp_path)
    store.append(rows(spark, [(1, "a", 0)]), "r", 0)
    store.append(rows(spark, [(2, "lost", 0)]), "r", 1)
    assert store.done("r", 1)
    again = store.append(rows(spark, [(3, "kept", 0)]), "r", 1)
    assert content(store) == [(1, "a", 0), (3, "kept", 0)] and again.number == 2
    # a new run (its checkpoint was lost) numbers its batches from 0 again
    store.append(rows(spark, [(4, "b", 0)]), "other", 0)
    assert content(store) == [(1, "a", 0), (3, "kept", 0), (4, "b", 0)]


def test_an_unfinished_version_is_not_seen(spark, tmp_path):
    store = make(spark, tmp_path)
    store.append(rows(spark, [(1, "a", 0)]), "r", 0)
    store.append(rows(spark, [(2, "b", 0)]), "r", 1)
    os.unlink(tmp_path / "manifest/v=2/_SUCCESS")
    assert content(store) == [(1, "a", 0)] and store.base("r", 1).number == 1


def test_lookup_opens_what_may_hold_a_key(spark, tmp_path):
    store = make(spark, tmp_path)
    for batch in range(4):
        store.append(rows(spark, [(100 * batch + i, "x", 0) for i in range(100)]), "r", batch)
    v = store.version()
    assert len(v.parts) > 40
    found = store.candidates(rows(spark, [(205, "", 0)]), v)
    assert len(found) <= 2 and any("batch=2" in f for f in found)
    assert len(store.candidates(rows(spark, [(10 ** 9 + i, "", 0) for i in range(50)]), v)) <= 12       # few false hits, not 60 folders
    assert {r["k"] for r in store.lookup(rows(spark, [(5, "", 0), (399, "", 0)]), v).collect()} >= {5, 399}
    assert store.lookup(rows(spark, [(5, "", 0)]), None).count() == 0


def test_append_compacts_and_vacuum_removes(spark, tmp_path):
    store = make(spark, tmp_path, buckets=2)
    for batch in range(FOLDERS + 3):
        store.append(rows(spark, [(10 * batch + i, "x", batch) for i in range(8)]), "r", batch)
        per = [b for b, _, _ in store.version().parts]
        assert max(per.count(b) for b in per) <= FOLDERS
    every = [(10 * b + i, "x", b) for b in range(FOLDERS + 3) for i in range(8)]
    assert content(store) == sorted(every)
    assert store.vacuum(keep=1) and content(store) == sorted(every) and store.versions() == [FOLDERS + 3]


def test_empty_changes(spark, tmp_path):
    store = make(spark, tmp_path)
    assert store.version() is None and store.read().count() == 0
    store.append(rows(spark, []), "r", 0)
    assert content(store) == [] and store.done("r", 0)
    store.merge(rows(spark, [(1, "a", 0)]), last, "r", 1)
    assert content(store) == [(1, "a", 0)]
    emptied = store.merge(rows(spark, [(1, "a", 0)]), lambda old, new: old.where(F.lit(False)), "r", 2)
    assert emptied.parts == () and content(store) == []


def test_null_keys_have_a_bucket(spark, tmp_path):
    store = make(spark, tmp_path)
    v = store.append(rows(spark, [(None, "a", 0), (None, "b", 0)]), "r", 0)
    assert store.lookup(rows(spark, [(None, "", 0)]), v).count() == 2


def test_run_and_append_rows(spark, tmp_path):
    folder = str(tmp_path / "ckpt")
    assert run_id(spark, folder) == run_id(spark, folder) and len(children(spark, folder, "_run-")) == 1
    path = str(tmp_path / "raw")
    df = rows(spark, [(1, "d1", 0), (2, "d2", 0)])
    append_rows(df, path, "r", 0, ["name"])
    append_rows(df, path, "r", 0, ["name"])
    append_rows(df.limit(1), path, "r", 1, ["name"])
    got = spark.read.parquet(path)
    assert got.count() == 3 and set(got.columns) == {"k", "v", "name", "run", "batch"}
    with pytest.raises(Exception):
        children(spark, "nosuchscheme://x/y", "v=")
