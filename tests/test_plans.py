"""Physical-plan properties the design relies on."""

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = E.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_reaches_the_scan(spark):
    p = plan(spark, "q_category")
    assert "EqualTo(category,en)" in p and "EqualTo(is_duplicate,false)" in p.replace("Not(EqualTo(is_duplicate,true))", "EqualTo(is_duplicate,false)")


@pytest.mark.parametrize("key,inside", [("q_by_id", "EqualTo(id,7)"), ("q_day", "published_at"), ("q_date_range", "published_at")])
def test_read_path_is_one_pruned_scan(spark, key, inside):
    p = plan(spark, key)
    assert p.count("FileScan") == 1 and "Join" not in p and "Exchange" not in p
    part = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", p)
    assert inside in part.group(2 if key == "q_by_id" else 1)


def test_read_table_has_bloom_filters_and_days(spark, tmp_path):
    """Files of one day lie in its folder; an id outside a file's Bloom filter is
    skipped without reading a page."""
    from articleflow.operators import articles as AR
    from articleflow.plans import catalog as Q
    path = str(tmp_path / "t")
    AR.write_article_table(Q._a(spark, SF), Q._s(spark, SF), path)
    folders = [d for d in os.listdir(path) if d.startswith("published_at=")]
    assert len(folders) == 14
    table = AR.read_article_table(spark, path)
    joined = AR.articles_joined(Q._a(spark, SF), Q._s(spark, SF))
    assert table.columns == joined.columns and table.dtypes == joined.dtypes
    assert sorted(map(str, table.collect())) == sorted(map(str, joined.collect()))
    sizes = [os.path.getsize(f"{path}/{d}/{f}") for d in folders for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
    plain = str(tmp_path / "plain")
    joined.repartitionByRange("published_at", "id").sortWithinPartitions("published_at", "id").write.partitionBy("published_at").parquet(plain)
    without = [os.path.getsize(f"{plain}/{d}/{f}") for d in folders for f in os.listdir(f"{plain}/{d}") if f.endswith(".parquet")]
    assert sum(sizes) > sum(without)             # the filters are there


def test_keyword_scan_reads_only_needed_columns(spark):
    p = plan(spark, "top_keywords")
    assert "n_chars" not in p
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("key", ["similar_flag", "dedup_skip", "source_budget", "feed_state", "hash_vector",
                                 "articles_joined", "daily_keywords", "events"])
def test_no_cartesian_products(spark, key):
    p = plan(spark, key)
    assert "CartesianProduct" not in p


def test_first_wins_is_an_aggregate_not_a_window(spark):
    p = plan(spark, "dedup_skip")
    assert "min_by" in p and "Window" not in p
