"""queries() against oracle_sql() on sf0.001 (the driver runs all keys at
sf0.01): same columns, same row count, same order-insensitive values."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import digest  # noqa: E402

from articleflow.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = ["top_keywords", "trend_rising", "url_normalized", "page_extract", "clean_valid", "similar_flag",
        "merge_clean_upsert", "q_keyword", "article_page", "sentiment_pivot", "quality_metrics", "hash_vector",
        "feed_items", "source_budget", "stream_daily", "insight_digest", "summaries_built", "health_metrics",
        "similar_groups", "cosine_pairs", "cosine_classes", "events", "event_top", "tone_verdict"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(sql) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["today", "token", "today_n"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", KEYS)
def test_oracle_match(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
