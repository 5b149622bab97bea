"""Streaming jobs: stream = batch, multi-epoch state, idempotent reruns."""

import datetime

from pyspark.sql import functions as F

from articleflow.operators import ingest as IN
from articleflow.sources import feeds as FD
from articleflow.streaming import jobs as SJ

SF = "/root/testdata/sf0.001"


def test_stream_daily_equals_batch(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = SJ.scratch(spark, "t-daily")
    SJ.daily_counts_stream(spark, SF, ev.schema, out, glob="events.parquet")
    got = {(r["day"], r["event_type"]): r["n"] for r in spark.read.parquet(out).collect()}
    want = {(r["d"], r["event_type"]): r["n"] for r in
            ev.groupBy(F.to_date("ts").alias("d"), "event_type").count().withColumnRenamed("count", "n").collect()}
    assert got == want


SAMPLE = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>t</title>
<item><title>A chip story</title><link>https://ex.com/a</link><guid>guid-a</guid>
<pubDate>Wed, 22 Jul 2026 18:00:00 +0900</pubDate></item>
<item><title>B heat story</title><link>https://ex.com/b</link><guid>guid-b</guid>
<pubDate>Wed, 22 Jul 2026 17:00:00 +0900</pubDate></item>
<item><title>no link</title><guid>guid-c</guid></item>
</channel></rss>"""


def _payloads(spark, texts):
    return spark.createDataFrame([("s", "c", i, t) for i, t in enumerate(texts)],
                                 "source string, category string, feed_no long, payload string")


def test_parse_feed(spark):
    items = FD.parse_feed(_payloads(spark, [SAMPLE, "<rss><channel></channel></rss>", "not xml"])).collect()
    assert [r["guid"] for r in items] == ["guid-a", "guid-b"]
    assert items[0]["published_at"] == "2026-07-22T09:00:00+00:00" and items[0]["method"] == "rss"


def _state(spark, cursors, keys):
    return IN.FeedState(spark.createDataFrame(cursors, IN.CURSORS), spark.createDataFrame(keys, IN.KEYS))


def test_filter_new_and_cursor(spark):
    items = FD.parse_feed(_payloads(spark, [SAMPLE]))
    state = _state(spark, [("s", "c", None)], [("s", "c", "guid-a", None), ("s", "other", "guid-b", None)])
    assert [r["guid"] for r in IN.filter_new(items, state).collect()] == ["guid-b"]
    cut = _state(spark, [("s", "c", "2026-07-22T09:00:00+00:00")], [])
    assert IN.filter_new(items, cut).count() == 0          # time <= cursor drops, equal too
    assert IN.filter_new(items, cut, incremental=False).count() == 2
    assert [r["url"] for r in IN.apply_query(items, "HEAT").collect()] == ["https://ex.com/b"]


def test_next_state_cap_and_cursor(spark):
    kept = spark.createDataFrame([("s", "c", f"g{i}", f"2026-07-22T0{i}:00:00+00:00") for i in range(6)],
                                 "source string, category string, guid string, published_at string")
    old = _state(spark, [("s", "c", "2026-07-23T00:00:00+00:00"), ("s", "other", "2026-07-01T00:00:00+00:00")],
                 [("s", "c", "old1", None), ("s", "c", "g0", None), ("s", "other", "x", "t")])
    st = IN.next_state(kept, old, cap=3)
    assert sorted(map(tuple, st.cursors.collect())) == [("s", "c", "2026-07-23T00:00:00+00:00"),     # never below the old cursor
                                                        ("s", "other", "2026-07-01T00:00:00+00:00")]
    assert sorted(map(tuple, st.keys.select("category", "guid").collect())) == [("c", "g3"), ("c", "g4"), ("c", "g5"), ("other", "x")]
    whole = IN.next_state(kept, old)
    assert sorted(r["guid"] for r in whole.keys.collect()) == ["g0", "g1", "g2", "g3", "g4", "g5", "old1", "x"]
    assert whole.keys.where("guid = 'g0'").first()["t"] == "2026-07-22T00:00:00+00:00"


def test_ingest_stream_two_epochs_then_rerun(spark):
    base = SJ.scratch(spark, "t-ingest")
    land = base + "/landing"
    _payloads(spark, [SAMPLE]).write.parquet(land)
    feeds = spark.createDataFrame([("s", "c", "u", 1)], "source string, category string, feed_url string, feed_pos long")
    SJ.ingest_stream(spark, land, spark.read.parquet(land).schema, feeds, base + "/state", base + "/raw")
    assert spark.read.parquet(base + "/raw").count() == 2
    # the same payload lands again: the stored state drops both items
    _payloads(spark, [SAMPLE]).write.mode("append").parquet(land)
    SJ.ingest_stream(spark, land, spark.read.parquet(land).schema, feeds, base + "/state", base + "/raw")
    assert spark.read.parquet(base + "/raw").count() == 2
    cursors, keys = SJ.feed_stores(spark, base + "/state")
    assert list(map(tuple, cursors.read().collect())) == [("s", "c", "2026-07-22T09:00:00+00:00")]
    assert sorted(r["guid"] for r in keys.read().collect()) == ["guid-a", "guid-b"]
    # the checkpoint is lost: the files are read again under a new run, and nothing is taken twice or hidden
    import shutil
    shutil.rmtree(base + "/state._ckpt")
    SJ.ingest_stream(spark, land, spark.read.parquet(land).schema, feeds, base + "/state", base + "/raw")
    raw = spark.read.parquet(base + "/raw")
    assert raw.count() == 2 and "collected_date" in raw.columns
    assert sorted(r["guid"] for r in keys.read().collect()) == ["guid-a", "guid-b"]


def test_a_title_query_loses_no_item(spark):
    """Items that one run's query leaves out are taken by a later run without it."""
    base = SJ.scratch(spark, "t-query")
    land = base + "/landing"
    feeds = spark.createDataFrame([("s", "c", "u", 1)], "source string, category string, feed_url string, feed_pos long")
    for query, n in (("chip", 1), (None, 2)):
        _payloads(spark, [SAMPLE]).write.mode("append").parquet(land)
        SJ.ingest_stream(spark, land, spark.read.parquet(land).schema, feeds, base + "/state", base + "/raw", query=query)
        assert spark.read.parquet(base + "/raw").count() == n


def test_next_state_lossless_cursor(spark):
    kept = spark.createDataFrame([("s", "c", "g1", "2026-07-22T01:00:00+00:00"),
                                  ("s", "c", "g3", "2026-07-22T03:00:00+00:00")],
                                 "source string, category string, guid string, published_at string")
    dropped = spark.createDataFrame([("s", "c", "g2", "2026-07-22T02:00:00+00:00")],
                                    "source string, category string, guid string, published_at string")
    lossy = IN.next_state(kept, None)
    lossless = IN.next_state(kept, None, dropped=dropped)
    assert lossy.cursors.first()["last_pubdate"] == "2026-07-22T03:00:00+00:00"
    assert lossless.cursors.first()["last_pubdate"] == "2026-07-22T01:00:00+00:00"
    assert sorted(r["guid"] for r in lossless.keys.collect()) == ["g1", "g3"]


def test_select_feeds(spark):
    import pytest

    reg = spark.createDataFrame([("a", "x", "u1", 1), ("a", "y", "u2", 2), ("b", "x", "u3", 1)],
                                "source string, category string, feed_url string, feed_pos long")
    assert FD.select_feeds(reg, "all").count() == 3
    assert FD.select_feeds(reg, "a", category="y").count() == 1
    assert FD.select_feeds(reg, "random", seed=3).select("source").distinct().count() == 1
    with pytest.raises(ValueError):
        FD.select_feeds(reg, "a,zzz")


def test_retried_epoch_gives_the_same_tables(spark, tmp_path):
    """Losing the commit of the last epoch after its tables are written: the
    retry reads the epoch before, not its own first attempt."""
    from articleflow.sources import views as V
    from articleflow.streaming import jobs as SJ
    raw = str(tmp_path / "raw")
    rows = V.raw_plus_view(spark, "/root/testdata/sf0.001").coalesce(1)
    rows.where("id % 8 < 4").write.parquet(raw)
    rows.where("id % 8 >= 4").coalesce(1).write.mode("append").parquet(raw)
    clean = str(tmp_path / "clean")
    schema = spark.read.parquet(raw).schema
    SJ.clean_stream(spark, raw, schema, clean, max_files=1)
    stores = [f(spark, clean) for f in (SJ.clean_store, SJ.title_store, SJ.ledger_store)]
    before = [sorted(map(str, x.read().collect())) for x in stores]
    commits = sorted((tmp_path / "clean._ckpt" / "commits").glob("[0-9]*"))
    assert len(commits) == 2
    for f in (tmp_path / "clean._ckpt" / "commits").glob("*1*"):
        f.unlink()
    SJ.clean_stream(spark, raw, schema, clean, max_files=1)
    assert [sorted(map(str, x.read().collect())) for x in stores] == before and len(before[0]) > 20
    assert len(before[2]) == spark.read.parquet(raw).count()
    # a lost checkpoint: every row is in the ledger already, so nothing changes
    import shutil
    shutil.rmtree(clean + "._ckpt")
    SJ.clean_stream(spark, raw, schema, clean, max_files=1)
    assert [sorted(map(str, x.read().collect())) for x in stores] == before


def test_clean_stream_equals_batch_and_rewrites_few_buckets(spark, tmp_path):
    """Three epochs with both policies against merges of whole tables; an epoch
    of one row rewrites one bucket of the table."""
    import os
    from articleflow.operators import clean as C
    from articleflow.operators import merge as M
    from articleflow.sources import views as V
    rows = V.raw_plus_view(spark, "/root/testdata/sf0.001").cache()
    parts = [rows.where("id % 4 = 0"), rows.where("id % 4 = 1"), rows.where("id % 4 > 1")]
    for policy in ("skip", "upsert"):
        clean, store = str(tmp_path / policy), None
        for n, part in enumerate(parts):
            land = str(tmp_path / f"{policy}-{n}")
            part.coalesce(1).write.parquet(land)
            for f in os.listdir(land):
                if f.endswith(".parquet"):
                    os.makedirs(str(tmp_path / f"{policy}-in"), exist_ok=True)
                    os.rename(f"{land}/{f}", str(tmp_path / f"{policy}-in" / f"{n}-{f}"))
            SJ.clean_stream(spark, str(tmp_path / f"{policy}-in"), rows.schema, clean, policy, dedup_similar=True)
            valid = C.clean_valid(part)
            empty = spark.createDataFrame([], C.STORED)
            merged = M.merge_clean(empty if store is None else store, valid, policy, True).select(*C.STORED.names)
            store = spark.createDataFrame(merged.collect(), C.STORED)
        got = SJ.clean_store(spark, clean).read()
        assert sorted(map(str, got.collect())) == sorted(map(str, store.collect())) and got.count() > 20
        titles = SJ.title_store(spark, clean).read().select("title_hash", "id")
        assert sorted(map(tuple, titles.collect())) == sorted(map(tuple, got.where("NOT is_duplicate").select("title_hash", "id").collect()))
    one = rows.where("id = 0").withColumn("id", F.lit(10 ** 6).cast("long")).withColumn("url", F.lit("https://new.example/one"))
    one.coalesce(1).write.mode("append").parquet(str(tmp_path / "skip-in"))
    table = SJ.clean_store(spark, str(tmp_path / "skip"))
    held = len(table.version().parts)
    SJ.clean_stream(spark, str(tmp_path / "skip-in"), rows.schema, str(tmp_path / "skip"), "skip")
    parts_now = table.version().parts
    assert len({f for _, f, _ in parts_now if "batch=3" in f}) == 1 and len(parts_now) >= held > 10
    rows.unpersist()


def test_no_limit_and_no_cap_by_default(spark):
    """600 undated items of one feed: all are taken, and none again."""
    schema = "source string, category string, guid string, published_at string, feed_no long, item_pos long"
    items = spark.createDataFrame([("s", "c", f"g{i}", None, 1, i) for i in range(600)], schema)
    feeds = spark.createDataFrame([("s", "c", 1)], "source string, category string, feed_pos long")
    kept = IN.source_budget(items, feeds)
    assert kept.count() == 600
    state = IN.next_state(kept, None)
    assert IN.filter_new(items, state).count() == 0 and state.keys.count() == 600
    assert IN.source_budget(items, feeds, 20).count() == 20


def test_budgeted_stream_takes_the_rest_later(spark):
    """A budget of one item a run, the newest item first in the feed."""
    item = "<item><title>t{0}</title><link>https://ex.com/{0}</link><guid>g{0}</guid>" \
        "<pubDate>Wed, 22 Jul 2026 0{0}:00:00 +0000</pubDate></item>"
    feed = "<rss><channel>" + "".join(item.format(i) for i in (3, 2, 1)) + "</channel></rss>"
    base = SJ.scratch(spark, "t-budget")
    land = base + "/landing"
    feeds = spark.createDataFrame([("s", "c", "u", 1)], "source string, category string, feed_url string, feed_pos long")
    for n in (1, 2, 3, 3):
        _payloads(spark, [feed]).write.mode("append").parquet(land)
        SJ.ingest_stream(spark, land, spark.read.parquet(land).schema, feeds, base + "/state", base + "/raw", limit=1)
        assert spark.read.parquet(base + "/raw").select("guid").distinct().count() == n
    assert spark.read.parquet(base + "/raw").count() == 3


def test_dedup_stream_takes_late_items_and_no_late_copy(spark):
    """One file a batch: an item older than all before it stays, a copy that
    comes a month after the first goes."""
    base = SJ.scratch(spark, "t-dedup")
    land, out = base + "/landing", base + "/out"
    schema = "source string, guid string, published_ts timestamp"
    waves = [[("s", "a", 1), ("s", "a", 1), (None, "n", 1)], [("s", "b", 28)], [("s", "c", 2), (None, "n", 28)], [("s", "a", 28)]]
    for wave in waves:
        rows = [(s, g, datetime.datetime(2026, 7, d)) for s, g, d in wave]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        SJ.dedup_stream(spark, land, spark.read.parquet(land).schema, out, max_files=1)
    got = sorted((r["source"] or "", r["guid"]) for r in spark.read.parquet(out).collect())
    assert got == [("", "n"), ("s", "a"), ("s", "b"), ("s", "c")]


ATOM = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:media="http://search.yahoo.com/mrss/"><title>f</title>
<entry><media:title>no</media:title><title type="html">A &amp; B</title><link rel="self" href="https://ex.com/self"/>
<link rel="alternate" href="https://ex.com/a?x=1&amp;y=2"/><id>tag:a</id><author><name>Kim</name><uri>u</uri></author>
<source><title>other</title><id>other</id></source><updated>2026-07-22T09:00:00Z</updated></entry>
<entry><title>t2</title><link href="https://ex.com/b"/><published>2026-07-22T10:00:00+09:00</published></entry></feed>"""
RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"
 xmlns:d="http://purl.org/dc/elements/1.1/"><channel rdf:about="c"><title>f</title><link>https://ex.com</link></channel>
<item rdf:about="id-a"><title>A</title><link> https://ex.com/a </link><d:date>2026-07-22T18:00:00+09:00</d:date><d:creator>Lee</d:creator></item></rdf:RDF>"""
BROKEN = """<rss><channel><title>f &nbsp; R&D</title><item><title><![CDATA[a <b> & c]]></title><link>https://ex.com/a</link></item>
<item><title>x &hellip; y &bogus; z</title><guid isPermaLink="true">https://ex.com/b</guid><item><title>never closed</title><link>https://ex.com/c</link>
<item><title>cut</title><link>https://ex.com/cu"""


def test_feed_layouts_and_broken_feeds(spark):
    got = FD.parse_feed(_payloads(spark, [ATOM, RDF, BROKEN, None, "", "<<<>>> & <item"])).orderBy("feed_no", "item_pos").collect()
    rows = [(r["feed_no"], r["guid"], r["url"], r["title"], r["published_at"]) for r in got]
    assert rows == [
        (0, "tag:a", "https://ex.com/a?x=1&y=2", "A & B", "2026-07-22T09:00:00+00:00"),
        (0, "https://ex.com/b", "https://ex.com/b", "t2", "2026-07-22T01:00:00+00:00"),
        (1, "id-a", "https://ex.com/a", "A", "2026-07-22T09:00:00+00:00"),
        (2, "https://ex.com/a", "https://ex.com/a", "a <b> & c", None),
        (2, "https://ex.com/b", "https://ex.com/b", "x … y &bogus; z", None),
        (2, "https://ex.com/c", "https://ex.com/c", "never closed", None)]
    import json
    assert json.loads(got[0]["raw_json"])["author"] == "Kim" and json.loads(got[2]["raw_json"])["author"] == "Lee"
    with_address = _payloads(spark, [RDF]).withColumn("feed_url", F.lit("https://ex.com/feed"))
    out = FD.parse_feed(with_address)
    assert json.loads(out.first()["raw_json"])["feed_url"] == "https://ex.com/feed" and "feed_url" not in out.columns


def test_a_page_fetched_twice_gives_one_item(spark):
    items = FD.parse_feed(_payloads(spark, [SAMPLE]))
    pages = spark.createDataFrame([("https://ex.com/a", "T", None), ("https://ex.com/a", "T2", "body"), ("https://ex.com/a", "T2", "body")],
                                  "url string, title string, body string")
    got = sorted((r["guid"], r["body"], r["crawl_status"]) for r in FD.crawl_outcome(items, pages).collect())
    assert got == [("guid-a", "body", "ok"), ("guid-b", None, "failed")]
