"""The report: one scan of each input, sections, the ordered sink."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from articleflow.operators import report as RP
from articleflow.plans import catalog as Q

SF = "/root/testdata/sf0.001"


def test_sections_and_sink(spark, tmp_path):
    rows = E.queries()["report_full"](spark, SF)
    assert rows.columns == list(RP.REPORT_COLUMNS)
    want = sorted((RP.SECTIONS.index(r["section"]), r["rank"], r["key"], r["n"], None if r["value"] is None else round(r["value"], 6)) for r in rows.collect())
    assert {RP.SECTIONS[w[0]] for w in want} >= {"metrics", "category", "source", "sentiment", "keyword", "insight"}
    path = str(tmp_path / "report")
    with pytest.raises(FileNotFoundError):
        RP.read_report(spark, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder = RP.write_report(rows, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(f for f in os.listdir(folder) if f.endswith(".csv"))
    assert len(files) > 1
    got = []
    for f in files:                              # the files in name order are the report in order
        part = spark.read.schema("section string, rank long, key string, n long, value double").options(header=True, quote='"', escape='"', multiLine=True)
        got += [(RP.SECTIONS.index(r["section"]), r["rank"], r["key"], r["n"], None if r["value"] is None else round(r["value"], 6))
                for r in part.csv(f"{folder}/{f}").collect()]
    assert got == want
    # a version that was not finished is not read
    second = RP.write_report(rows.where("section = 'metrics'"), path)
    assert {r["section"] for r in RP.read_report(spark, path).select("section").distinct().collect()} == {"metrics"}
    os.unlink(f"{second}/_SUCCESS")
    assert RP.read_report(spark, path).count() == len(want)


def test_sections_come_from_the_narrow_tables(spark):
    """No section goes back to the pages or documents."""
    plan = Q.QUERIES["report_rows"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in plan and "doc_id" not in plan and "page_id" not in plan


def test_empty_inputs(spark):
    a = spark.createDataFrame([], "id long, title string, category string, source string, published_at date, is_duplicate boolean")
    s = spark.createDataFrame([], "article_id long, orig_len long, summary_len long, sentiment string")
    r = spark.createDataFrame([], "crawl_status string")
    assert {x["section"] for x in RP.report_rows(r, a, s).collect()} == {"metrics"}
