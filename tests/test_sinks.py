"""Sinks: CSV export with display headers and cut cells, snapshot versions."""

import csv
import datetime
import io

from pyspark.sql import functions as F

from articleflow import constants as K
from articleflow.operators import articles as AR
from articleflow.operators import digest as DG
from articleflow.operators import merge as M
from articleflow.session import checkpoint_dir


def _joined(spark):
    long_body = "x" * (K.EXPORT_CELL_LIMIT + 5)
    return spark.createDataFrame(
        [(1, "u1", "t1", "h", long_body, "IT", "s1", datetime.date(2026, 7, 22), False, "sum", "positive", 10, 3)],
        "id long, url string, title string, title_hash string, body string, category string, source string, "
        "published_at date, is_duplicate boolean, summary string, sentiment string, orig_len long, summary_len long")


def test_export_view_cuts_long_cells(spark):
    assert len(AR.export_view(_joined(spark)).first()["body"]) == K.EXPORT_CELL_LIMIT + 5
    row = AR.export_view(_joined(spark), K.EXPORT_CELL_LIMIT).first()
    assert [c for c, _ in K.EXPORT_COLUMNS] == list(row.asDict().keys())
    assert row["body"].endswith(K.EXPORT_CUT_SUFFIX) and len(row["body"]) == K.EXPORT_CELL_LIMIT + len(
        K.EXPORT_CUT_SUFFIX)


def test_export_csv_headers(spark):
    path = checkpoint_dir(spark).rstrip("/") + "/test-export"
    AR.export_csv(_joined(spark), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == [h for _, h in K.EXPORT_COLUMNS]
    assert back.count() == 1


def test_export_csv_reads_back(spark):
    body = 'a "quoted" cell\nnext line\r, comma \\" end '
    df = _joined(spark).withColumn("title", F.lit('"q"')).withColumn("body", F.lit(body))
    path = checkpoint_dir(spark).rstrip("/") + "/test-export-quotes"
    AR.export_csv(df, path)
    files = [list(csv.reader(io.StringIO(r.value, newline=""))) for r in spark.read.text(path, wholetext=True).collect()]
    assert all(f[0] == [h for _, h in K.EXPORT_COLUMNS] for f in files)
    [row] = [r for f in files for r in f[1:]]
    cells = dict(zip([k for k, _ in K.EXPORT_COLUMNS], row))
    assert cells["title"] == '"q"' and cells["body"] == body


def test_keyword_folds_ascii_only(spark):
    df = _joined(spark).withColumn("body", F.lit("C:\\Temp É"))
    articles = df.drop("summary", "sentiment", "orig_len", "summary_len")
    summaries = df.select(F.col("id").alias("article_id"), "summary", "sentiment", "orig_len", "summary_len", F.lit("m").alias("model"))

    def found(keyword):
        return AR.query_articles(articles, summaries, keyword=keyword).count()
    assert [found(k) for k in ("c:\\TEMP", "\\", "É", "é", "t_mp", "x")] == [1, 1, 1, 0, 1, 0]


def test_as_list(spark):
    df = spark.createDataFrame([("x", ["a", "b"], 1), (None, None, None)], "s string, l array<string>, n int")
    rows = df.select(*[DG.as_list(df, c).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in rows] == [(["x"], ["a", "b"], ["1"]), ([], [], [])]


def test_write_snapshot_versions(spark):
    df = spark.createDataFrame([(1, "a")], "article_id long, summary string")
    p1 = M.write_snapshot(df, spark, "summaries")
    p2 = M.write_snapshot(df.withColumn("summary", F.lit("b")), spark, "summaries")
    assert p1 != p2
    assert spark.read.parquet(p1).first()["summary"] == "a"
    assert spark.read.parquet(p2).first()["summary"] == "b"
