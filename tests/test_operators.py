"""Relational operators on tiny literal frames."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from articleflow.operators import clean as C
from articleflow.operators import events as EV
from articleflow.operators import merge as M
from articleflow.operators import trends as TR

RAW_SCHEMA = ("id long, url string, title string, body string, category string, source string, "
              "published_at string, collected_at string, crawl_status string")
BODY = "본문 " * 60


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_validate_reasons(spark):
    rows = [
        (1, "https://ex.com/a", "제목입니다", BODY, "IT", "src1", "2026-07-22T09:00:00+00:00", "2026-07-22T10:00:00+09:00", "ok"),
        (2, "", "t", BODY, "IT", "s", None, None, "ok"),
        (3, "https://ex.com/c", "t", "짧음", "IT", "s", None, None, "ok"),
        (4, "https://ex.com/d", "제목", BODY, None, None, None, "2026-07-22T00:00:00+09:00", "ok"),
        (5, "https://ex.com/e", "", BODY, "IT", "s", None, None, "ok"),
        (6, "https://ex.com/f", "t", None, "IT", "s", None, None, "failed"),
    ]
    v = {r["raw_id"]: r for r in C.validate(_raw(spark, rows)).collect()}
    assert v[1]["reason"] == "ok" and v[1]["published_at"] == datetime.date(2026, 7, 22) and v[1]["title_hash"]
    assert v[2]["reason"] == "no_url"
    assert v[3]["reason"] == "short_body" and v[3]["body_len"] == 2
    assert v[4]["reason"] == "ok" and v[4]["category"] == "미분류" and v[4]["source"] == "미상"
    assert v[5]["reason"] == "no_title"
    assert v[6]["reason"] == "no_body"


def _batch(spark):
    rows = [
        (10, "https://ex.com/a?utm_source=x", "Same title", BODY, "IT", "s1", "2026.07.22", None, "ok"),
        (11, "https://ex.com/a", "Newer title", BODY, "IT", "s1", "2026.07.23", None, "ok"),
        (12, "https://ex.com/b", "Same title!", BODY, "IT", "s2", "2026.07.22", None, "ok"),
        (13, "https://ex.com/c", "!!!", BODY, "IT", "s2", "2026.07.22", None, "ok"),
        (14, "https://ex.com/d", "???", BODY, "IT", "s2", "2026.07.22", None, "ok"),
    ]
    return _raw(spark, rows)


def test_dedup_skip_and_similar(spark):
    valid = C.clean_valid(_batch(spark))
    win = {r["url"]: r for r in C.similar_flag(C.dedup_skip(valid)).collect()}
    assert win["https://ex.com/a"]["title"] == "Same title"        # first wins
    assert win["https://ex.com/b"]["is_duplicate"] is True         # same title hash, later id
    assert win["https://ex.com/a"]["is_duplicate"] is False
    assert not win["https://ex.com/d"]["is_duplicate"]              # empty title key never flags


def test_dedup_upsert_keeps_first_id(spark):
    valid = C.clean_valid(_batch(spark))
    up = {r["url"]: r for r in C.dedup_upsert(valid).collect()}
    assert up["https://ex.com/a"]["title"] == "Newer title" and up["https://ex.com/a"]["id"] == 10


def test_clean_stats_and_rerun(spark):
    raw = _batch(spark)
    stats = {r["outcome"]: r["n"] for r in C.clean_stats(raw, dedup_similar=True).collect()}
    assert stats == {"inserted": 4, "skipped": 1, "similar": 1}
    # the same batch again against the stored result: nothing new
    valid = C.clean_valid(raw)
    store = C.similar_flag(C.dedup_skip(valid)).withColumn("id", F.col("raw_id"))
    again = {r["outcome"]: r["n"] for r in C.clean_stats(raw, dedup_similar=True, store=store).collect()}
    assert again.get("inserted", 0) == 0 and again["skipped"] == 5


def test_merge_clean_skip_vs_upsert(spark):
    first = C.clean_valid(_raw(spark, [
        (1, "https://ex.com/a", "old title", BODY, "IT", "s", "2026.07.22", None, "ok")]))
    store = C.similar_flag(C.dedup_skip(first)).withColumn("id", F.col("raw_id"))
    batch = C.clean_valid(_raw(spark, [
        (2, "https://ex.com/a", "new title", BODY, "IT", "s", "2026.07.23", None, "ok"),
        (3, "https://ex.com/z", "zeta", BODY, "IT", "s", "2026.07.23", None, "ok")]))
    skip = {r["url"]: r for r in M.merge_clean(store, batch, "skip", True).collect()}
    assert skip["https://ex.com/a"]["title"] == "old title" and skip["https://ex.com/z"]["outcome"] == "inserted"
    up = {r["url"]: r for r in M.merge_clean(store, batch, "upsert", True).collect()}
    assert up["https://ex.com/a"]["title"] == "new title" and up["https://ex.com/a"]["id"] == 1
    assert up["https://ex.com/a"]["outcome"] == "updated"


def test_merge_last_wins(spark):
    store = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "article_id long, summary string, v long")
    batch = spark.createDataFrame([(1, "a2", 2), (1, "a3", 3), (3, "c", 1)], "article_id long, summary string, v long")
    got = {r["article_id"]: r["summary"] for r in M.merge_last_wins(store, batch, "article_id", "v").collect()}
    assert got == {1: "a3", 2: "b", 3: "c"}


def _articles(spark, rows):
    return spark.createDataFrame(
        [(i, t, datetime.date.fromisoformat(d), False) for i, (t, d) in enumerate(rows)],
        "id long, title string, published_at date, is_duplicate boolean")


def test_briefing_new_and_rising(spark):
    rows = [("chip", "2026-07-21"), ("profit profit", "2026-07-21"),
            ("chip", "2026-07-22"),
            ("chip chip chip chip chip", "2026-07-23"), ("heat heat heat", "2026-07-23"), ("profit", "2026-07-23")]
    a = _articles(spark, rows)
    new = {r["token"]: r["today_n"] for r in TR.trend_new(a, 7, 5, stopwords=[]).collect()}
    rising = {r["token"]: r for r in TR.trend_rising(a, 7, 5, stopwords=[]).collect()}
    assert new == {"heat": 3}
    assert set(rising) == {"chip"} and rising["chip"]["prior_avg"] == 1.0
    assert TR.trend_top_today(a, 7, 5, stopwords=[]).first()["today"] == datetime.date(2026, 7, 23)


def test_trend_window_counts_data_days(spark):
    a = _articles(spark, [("aaa", "2026-07-01"), ("bbb", "2026-07-05"), ("ccc", "2026-07-09")])
    days = [r["day"] for r in TR.trend_window(a, 2).orderBy("pos").collect()]
    assert days == [datetime.date(2026, 7, 9), datetime.date(2026, 7, 5)]


def test_hash_vector_unit_and_similarity(spark):
    df = spark.createDataFrame([(1, "삼성전자 반도체 실적 발표"), (2, "삼성전자 반도체 실적 호조"),
                                (3, "날씨 폭염 주의보 발효"), (4, "")], "id long, t string")
    rows = EV.hash_vectors(df, "id", F.col("t")).collect()
    vec = {}
    for r in rows:
        vec.setdefault(r["id"], np.zeros(256))[r["idx"]] = r["w"]
    assert np.isclose(np.linalg.norm(vec[1]), 1.0)
    assert vec[1] @ vec[2] > vec[1] @ vec[3]
    assert 4 not in vec   # empty text -> zero vector


def test_tone_verdict(spark):
    m = spark.createDataFrame([("b", 1, 1, "positive"), ("b", 1, 2, "negative"), ("b", 1, 3, "positive"),
                               ("b", 5, 5, "neutral")], "blk string, cluster long, id long, sentiment string")
    got = {r["cluster"]: r for r in EV.tone_verdict(m, ["blk"]).collect()}
    assert got[1]["verdict"] == "split" and got[1]["label1"] == "긍정" and got[1]["n1"] == 2
    assert got[5]["verdict"] == "agree" and got[5]["label2"] is None


def test_components_link_through_shared_keys(spark):
    from articleflow.operators import components as CC

    # 1-2 share a title, 2-3 share a text, 4 alone, 5-6 share a text
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "y"), (4, "c", "z"), (5, "d", "w"),
                                (6, "e", "w")], "id long, t string, b string")
    edges = CC.key_edges(df, "id", {"title": F.col("t"), "text": F.col("b")})
    got = {r["id"]: (r["component"], r["size"]) for r in CC.groups(CC.components(edges)).collect()}
    assert got == {1: (1, 3), 2: (1, 3), 3: (1, 3), 5: (5, 2), 6: (5, 2)}


def test_hash_buckets_match_md5_mod(spark):
    import hashlib

    text = "Samsung chip profit 반도체 a"
    toks = ["samsung", "chip", "profit", "반도체", "a"]
    grams = toks + [t[i:i + 2] for t in toks for i in range(len(t) - 1)]
    df = spark.createDataFrame([(text,)], "t string")
    for dim in (256, 16, 100):
        got = sorted(df.select(EV.hash_buckets(F.col("t"), dim).alias("b")).first()["b"])
        want = sorted(int(hashlib.md5(g.encode()).hexdigest(), 16) % dim for g in grams)
        assert got == want, dim


def test_variant_ids_never_meet(spark):
    """Rows of R+ for large page ids: numbered apart, split by variant."""
    from articleflow.sources import views as V
    ids = [(p * V.VARIANTS + v, v) for p in (999_999, 1_000_000, 2_000_001, 3_000_000) for v in range(4)]
    df = spark.createDataFrame(ids, "raw_id long, v int")
    assert df.select("raw_id").distinct().count() == 16
    assert {r.v for r in df.where(V.is_original(F.col("raw_id"))).collect()} == {0}


def test_article_flags_move_no_bodies(spark, tmp_path):
    """Later rows of a title hash are flagged, an empty title key never is; the
    joins by title carry no texts."""
    from articleflow.sources import views as V
    rows = [(1, "same title\na"), (2, "same title\nb"), (2, "other\nc"), (3, "!!\nd"), (4, "!!\ne"), (None, "same title\nf"), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    a = V.article_view(spark, str(tmp_path))
    assert sorted((r["id"] or 0, r["body"] or "", r["is_duplicate"]) for r in a.collect()) == [
        (0, "same title\nf", False), (1, "same title\na", False), (2, "other\nc", False), (2, "same title\nb", True),
        (3, "!!\nd", False), (4, "!!\ne", False), (5, "", False)]
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    # the join with the bodies is by id, the one by title is below the aggregate
    assert "_id" in joins[0] and "title_hash" not in joins[0]
