"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through the views of
:mod:`articleflow.sources.views`) in full and applies one operator of the
inventory with the reference's default parameters.  The SQL oracle for the
same names lives in :mod:`articleflow.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dates as D
from ..functions import labels as L
from ..functions import text as T
from ..functions import urls as U
from ..operators import articles as AR
from ..operators import clean as C
from ..operators import components as CC
from ..operators import digest as DG
from ..operators import events as EV
from ..operators import ingest as IN
from ..operators import merge as M
from ..operators import metrics as MT
from ..operators import report as RP
from ..operators import similarity as SI
from ..operators import trends as TR
from ..session import checkpoint_dir, stage
from ..sources import feeds as FD
from ..sources import views as V
from ..sources.pages import page_extract as _page_extract
from ..sources.tables import read_table
from ..streaming import jobs as SJ

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Filter values used by the read-path queries (they exist at every scale).
CATEGORY = "en"
SOURCE = "src3"
DAY = "2024-01-05"
DATE_FROM, DATE_TO = "2024-01-03", "2024-01-09"
KEYWORD = "the"
ARTICLE_ID = 7
AS_OF = "2024-01-05"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _a(spark, sf):
    return V.article_view(spark, sf)


def _s(spark, sf):
    return V.summaries_view(spark, sf)


# --------------------------------------------------------------------------
# keywords and trends
# --------------------------------------------------------------------------
@query
def top_keywords(spark, sf):
    return TR.top_keywords(_a(spark, sf), K.TOP_N)


@query
def daily_keywords(spark, sf):
    return TR.daily_keywords(_a(spark, sf), K.TREND_DAYS)


@query
def trend_window(spark, sf):
    return TR.trend_window(_a(spark, sf), K.TREND_DAYS)


@query
def trend_top_today(spark, sf):
    return TR.trend_top_today(_a(spark, sf), K.TREND_DAYS, K.TOP_N)


@query
def trend_new(spark, sf):
    return TR.trend_new(_a(spark, sf), K.TREND_DAYS, K.TOP_N)


@query
def trend_rising(spark, sf):
    return TR.trend_rising(_a(spark, sf), K.TREND_DAYS, K.TOP_N)


@query
def keyword_timeline(spark, sf):
    return TR.keyword_timeline(_a(spark, sf), K.TREND_DAYS, max(K.TOP_N, 6))


# --------------------------------------------------------------------------
# scalar layer over whole tables
# --------------------------------------------------------------------------
@query
def title_hash(spark, sf):
    d = read_table(spark, sf, "documents")
    line = T.first_line(F.col("text"))
    return d.select("doc_id", T.title_hash(line).alias("title_hash"))


@query
def keyword_tokens(spark, sf):
    a = _a(spark, sf)
    return a.select("id", F.posexplode(T.keyword_tokens(F.col("title"))).alias("pos", "token")) \
        .select("id", F.col("pos").cast("long").alias("pos"), "token")


@query
def url_normalized(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", "url", U.normalize_url(F.col("url")).alias("norm_url"))


@query
def date_normalized(spark, sf):
    r = V.raw_view(spark, sf)
    return r.select("id", "published_at", "collected_at",
                    D.normalize_date(F.col("published_at"), F.col("collected_at")).alias("day"))


@query
def page_extract(spark, sf):
    return _page_extract(read_table(spark, sf, "pages")).select("page_id", "title", "body")


@query
def text_normalized(spark, sf):
    r = V.raw_view(spark, sf)
    return r.select("id", T.normalize_text(F.col("title"), False).alias("title"),
                    T.normalize_text(F.col("body"), True).alias("body"))


@query
def extractive_summary(spark, sf):
    d = read_table(spark, sf, "documents")
    s = T.extractive_summary(F.col("text"), K.SUMMARY_MAX_CHARS)
    return d.select("doc_id", s.alias("summary")).select("doc_id", "summary",
                                                          F.length("summary").cast("long").alias("summary_len"))


#: Hint words that occur in the test texts.
LATIN_POSITIVE, LATIN_NEGATIVE = ("the ", "und ", "la ", "tion"), ("of ", "der ", "que ", "ing")
#: Spellings of labels, given to the summaries by id.
SPELLINGS = ("긍정", " Positive ", "NEG", "부정적", "neu", "mixed", "", None, "angry", "negative")


@query
def lexicon_sentiment(spark, sf):
    a = _a(spark, sf)
    return a.select("id", L.lexicon_sentiment(F.concat(F.col("title"), F.col("body")), LATIN_POSITIVE, LATIN_NEGATIVE).alias("sentiment"))


@query
def label_normalized(spark, sf):
    """F9 / F10 over labels as models spell them."""
    given = F.element_at(F.array(*[F.lit(x).cast("string") for x in SPELLINGS]), (F.pmod("article_id", F.lit(len(SPELLINGS))) + 1).cast("int"))
    s = _s(spark, sf).withColumn("sentiment", given)
    return s.select("article_id", L.normalize_label(F.col("sentiment")).alias("label"),
                    L.display_label(F.col("sentiment")).alias("display"))


# --------------------------------------------------------------------------
# clean path
# --------------------------------------------------------------------------
def _rp(spark, sf):
    return V.raw_plus_view(spark, sf)


@query
def clean_valid(spark, sf):
    return C.clean_valid(_rp(spark, sf))


@query
def clean_rejects(spark, sf):
    """P11 split: the rejected raw rows with their first failing rule."""
    v = C.validate(_rp(spark, sf))
    return v.where(F.col("reason") != "ok").select("raw_id", "reason", "body_len")


@query
def reject_reasons(spark, sf):
    """Reject-reason histogram (a short body is bucketed by length)."""
    return C.clean_rejects(_rp(spark, sf))


@query
def dedup_skip(spark, sf):
    return C.dedup_skip(C.clean_valid(_rp(spark, sf)))


@query
def dedup_upsert(spark, sf):
    return C.dedup_upsert(C.clean_valid(_rp(spark, sf)))


@query
def similar_flag(spark, sf):
    return C.similar_flag(C.dedup_skip(C.clean_valid(_rp(spark, sf))))


@query
def clean_stats(spark, sf):
    return C.clean_stats(_rp(spark, sf), policy="skip", dedup_similar=True)


def _store_and_batch(spark, sf):
    """Store = clean snapshot of R (first run); batch = the re-fetched rows."""
    valid = C.clean_valid(_rp(spark, sf))
    first_run = valid.where(V.is_original(F.col("raw_id")))
    store = C.similar_flag(C.dedup_skip(first_run)).withColumn("id", F.col("raw_id"))
    batch = valid.where(~V.is_original(F.col("raw_id")))
    return store, batch


@query
def merge_clean(spark, sf):
    store, batch = _store_and_batch(spark, sf)
    return M.merge_clean(store, batch, policy="skip", dedup_similar=True)


@query
def merge_clean_upsert(spark, sf):
    store, batch = _store_and_batch(spark, sf)
    return M.merge_clean(store, batch, policy="upsert", dedup_similar=True)


# --------------------------------------------------------------------------
# read path
# --------------------------------------------------------------------------
_READ_TABLES: dict[tuple[str, str], str] = {}


def _read_table(spark, sf):
    """The clustered read table of a folder's documents, stored once in a session
    (the folder's tables do not change while it runs)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _READ_TABLES:
        path = f"{checkpoint_dir(spark).rstrip('/')}/tables/articles-{uuid.uuid4().hex}"
        AR.write_article_table(_a(spark, sf), _s(spark, sf), path)
        _READ_TABLES[key] = path
    return AR.read_article_table(spark, _READ_TABLES[key])


def _q(spark, sf, **kw):
    return AR.query_table(_read_table(spark, sf), **kw)


@query
def articles_joined(spark, sf):
    return AR.articles_joined(_a(spark, sf), _s(spark, sf)).drop("_summarized")


@query
def q_by_id(spark, sf):
    return _q(spark, sf, article_id=ARTICLE_ID)


@query
def q_category(spark, sf):
    return _q(spark, sf, category=CATEGORY)


@query
def q_source(spark, sf):
    return _q(spark, sf, source=SOURCE)


@query
def q_day(spark, sf):
    return _q(spark, sf, day=DAY)


@query
def q_date_range(spark, sf):
    return _q(spark, sf, date_from=DATE_FROM, date_to=DATE_TO)


@query
def q_keyword(spark, sf):
    return _q(spark, sf, keyword=KEYWORD)


@query
def q_summarized(spark, sf):
    return _q(spark, sf, status="summarized")


@query
def q_unsummarized(spark, sf):
    return _q(spark, sf, status="unsummarized")


@query
def q_no_dups(spark, sf):
    return _q(spark, sf)


@query
def article_page(spark, sf):
    return AR.article_page(_q(spark, sf, category=CATEGORY), page=3, page_size=K.PAGE_SIZE)


DEEP_PAGE = 25


@query
def article_page_deep(spark, sf):
    """A page far down, read from its range of the ranked articles."""
    return AR.ranked_articles(_q(spark, sf, category=CATEGORY)).page(DEEP_PAGE, K.PAGE_SIZE)


@query
def article_detail(spark, sf):
    j = AR.articles_joined(_a(spark, sf), _s(spark, sf))
    return AR.article_detail(j, ARTICLE_ID)


@query
def summary_targets(spark, sf):
    return AR.summary_targets(_a(spark, sf), _s(spark, sf), category=CATEGORY).select(
        "id", "title", "category", "published_at")


@query
def export_view(spark, sf):
    return AR.export_view(_q(spark, sf, status="summarized"))


# --------------------------------------------------------------------------
# counts and metrics
# --------------------------------------------------------------------------
@query
def raw_counts(spark, sf):
    return MT.raw_counts(_rp(spark, sf))


@query
def category_counts(spark, sf):
    return MT.category_counts(_a(spark, sf))


@query
def daily_counts(spark, sf):
    return MT.daily_counts(_a(spark, sf))


@query
def source_counts(spark, sf):
    return MT.source_counts(_a(spark, sf))


@query
def recent_days(spark, sf):
    return MT.recent_days(_a(spark, sf), 5)


@query
def sentiment_overall(spark, sf):
    return MT.sentiment_overall(_s(spark, sf))


@query
def sentiment_by_category(spark, sf):
    return MT.sentiment_by_category(_a(spark, sf), _s(spark, sf))


@query
def sentiment_pivot(spark, sf):
    return MT.sentiment_pivot(_a(spark, sf), _s(spark, sf))


@query
def quality_metrics(spark, sf):
    return MT.quality_metrics(_rp(spark, sf), _a(spark, sf), _s(spark, sf))


@query
def article_count(spark, sf):
    return MT.article_count(_q(spark, sf, category=CATEGORY))


# --------------------------------------------------------------------------
# vectors and events
# --------------------------------------------------------------------------



def _cluster_input(spark, sf, documents=None):
    """Articles with their F11 text: of all documents, or of some rows of them."""
    j = AR.articles_joined(V.article_view(spark, sf, documents), V.summaries_view(spark, sf, documents=documents))
    txt = T.cluster_text(F.col("title"), F.col("summary"), F.col("body"))
    return j.select("id", "title", "category", "source", "published_at", "sentiment", txt.alias("text"))


def _vectors(spark, sf):
    return EV.hash_vectors(_cluster_input(spark, sf), "id", F.col("text"))


@query
def hash_vector(spark, sf):
    return _vectors(spark, sf).select(F.col("id"), F.col("idx").cast("long").alias("idx"),
                                      F.round("w", 6).alias("w"))


@query
def vector_norm(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", F.posexplode(EV.unit(F.col("embedding"))).alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query
def similar_groups(spark, sf):
    """Every document with its group of similar whole texts (Jaccard
    of five-word shingles 0.8 or more, chains included) and the group's size."""
    return SI.similar_groups(read_table(spark, sf, "documents"), "doc_id").withColumnRenamed("id", "doc_id")


#: Cosine from which two embeddings are linked.
COSINE = 0.35


@query
def cosine_pairs(spark, sf):
    """V4: pairs of different embeddings whose cosine reaches the threshold
    (equal embeddings are one class, named by its smallest id)."""
    pairs, _, _ = SI.cosine_links(read_table(spark, sf, "embeddings"), COSINE, "vec_id", "embedding")
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


@query
def cosine_classes(spark, sf):
    """V4: every embedding with its class and the number of classes linked to it."""
    pairs, members, _ = SI.cosine_links(read_table(spark, sf, "embeddings"), COSINE, "vec_id", "embedding")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(ends, "c", "left").select(F.col("id").alias("vec_id"), F.col("c").alias("class_id"),
                                                  F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _members(spark, sf):
    """Members of the groups of similar texts with their attributes; the order
    inside a group is that of the ids.  Groups are found first, so that only
    their members' texts move and get vectors."""
    g = SI.similar_groups(read_table(spark, sf, "documents"), "doc_id").where("size >= 2")
    g = stage(g.select("id", F.col("component").alias("cluster"), F.col("id").alias("pos")), "members")
    documents = read_table(spark, sf, "documents")
    kept = stage(SI.held(documents.where("doc_id IS NOT NULL"), "doc_id", g.select("id")), "members-documents")
    texts = _cluster_input(spark, sf, kept).join(g.select("id"), "id", "left_semi")
    c = texts.join(EV.packed(EV.hash_vectors(texts, "id", F.col("text"))), "id", "left")
    return g.join(c.select("id", "title", "source", "sentiment", "published_at", "idx", "w"), "id")


def _staged_members(spark, sf):
    """Members, made once for steps that read them several times."""
    return stage(_members(spark, sf), "members-made")


@query
def event_rep(spark, sf):
    return EV.representatives(_staged_members(spark, sf), [])


@query
def events(spark, sf):
    return EV.events(_staged_members(spark, sf), [], K.EVENT_MIN_SOURCES)


@query
def tone_by_source(spark, sf):
    return EV.tone_by_source(_members(spark, sf), [])


@query
def tone_verdict(spark, sf):
    return EV.tone_verdict(_members(spark, sf), [])


# --------------------------------------------------------------------------
# ingest (S1-S5, S7-S9, P10, J3/J4, J8, W4-W6, M3)
# --------------------------------------------------------------------------

PREV_RUN_BEFORE = "2024-01-08"   # the previous fetch saw the first week
ITEM_QUERY = "the"


def _rfc_pub(day_col):
    return F.concat(F.date_format(day_col, "EEE, dd MMM yyyy"), F.lit(" 10:00:00 +0900"))


def _iso_pub(day_col):
    return F.concat(F.date_format(day_col, "yyyy-MM-dd"), F.lit("T10:00:00+09:00"))


def _payloads(raw):
    day = F.date_add(F.lit(V.EPOCH).cast("date"), F.pmod(F.col("id"), F.lit(V.N_DAYS)).cast("int"))
    return FD.feed_payloads(raw, _rfc_pub(day), _iso_pub(day))


def _items(spark, sf):
    return FD.parse_feed(_payloads(V.raw_view(spark, sf)))


def _prev_state(items):
    prev = items.where(F.col("published_at") < F.lit(PREV_RUN_BEFORE))
    return IN.next_state(prev, None)


ITEM_COLUMNS = ["source", "category", "feed_no", "item_pos", "guid", "url", "title", "published_at"]


@query
def feed_items(spark, sf):
    return _items(spark, sf).select(*ITEM_COLUMNS)


@query
def feed_select(spark, sf):
    return FD.select_feeds(FD.registry(V.raw_view(spark, sf)), category=CATEGORY)


@query
def item_query(spark, sf):
    return IN.apply_query(_items(spark, sf), ITEM_QUERY).select(*ITEM_COLUMNS)


@query
def filter_new(spark, sf):
    items = _items(spark, sf)
    return IN.filter_new(items, _prev_state(items)).select(*ITEM_COLUMNS)


def _budgeted(spark, sf):
    items = _items(spark, sf)
    state = _prev_state(items)
    fresh = IN.filter_new(items, state)
    feeds = FD.registry(V.raw_view(spark, sf))
    return IN.source_budget(fresh, feeds), state


@query
def source_budget(spark, sf):
    """W4 without a limit: every new item of the registered feeds."""
    kept, _ = _budgeted(spark, sf)
    return kept.select(*ITEM_COLUMNS)


@query
def source_budget_limited(spark, sf):
    """W4 with a limit: at most FETCH_LIMIT new items a source, by feed and place."""
    items = _items(spark, sf)
    fresh = IN.filter_new(items, _prev_state(items))
    return IN.source_budget(fresh, FD.registry(V.raw_view(spark, sf)), K.FETCH_LIMIT).select(*ITEM_COLUMNS, "budget_rank")


@query
def feed_cursor(spark, sf):
    kept, state = _budgeted(spark, sf)
    return IN.next_state(kept, state).cursors


@query
def feed_cursor_limited(spark, sf):
    """W5 after a limited run: the cursor stays below the items left behind."""
    items = _items(spark, sf)
    state = _prev_state(items)
    fresh = IN.filter_new(items, state)
    kept = IN.source_budget(fresh, FD.registry(V.raw_view(spark, sf)), K.FETCH_LIMIT)
    return IN.next_state(kept, state, dropped=fresh.join(kept.select(*IN.SEEN_KEY), IN.SEEN_KEY, "left_anti")).cursors


@query
def feed_state(spark, sf):
    """Each feed's cursor and number of seen keys."""
    kept, state = _budgeted(spark, sf)
    out = IN.next_state(kept, state)
    seen = out.keys.groupBy(*IN.FEED_KEY).agg(F.count(F.lit(1)).alias("n_seen"))
    return out.cursors.join(seen, IN.FEED_KEY, "left").select(*IN.CURSORS.names, F.coalesce("n_seen", F.lit(0)).alias("n_seen"))


@query
def crawl_outcome(spark, sf):
    kept, _ = _budgeted(spark, sf)
    pages = _page_extract(read_table(spark, sf, "pages"))
    return FD.crawl_outcome(kept, pages).select("source", "category", "guid", "url", "method", "title", "body",
                                               "crawl_status")


@query
def raw_sink(spark, sf):
    kept, _ = _budgeted(spark, sf)
    pages = _page_extract(read_table(spark, sf, "pages"))
    return IN.raw_rows(FD.crawl_outcome(kept, pages), "2024-01-15T09:00:00+09:00")


@query
def raw_guid_exists(spark, sf):
    return IN.guid_exists(_items(spark, sf), V.raw_view(spark, sf)).select(*ITEM_COLUMNS)


@query
def uncleaned(spark, sf):
    """Raw rows that are not in the ledger that an earlier cleaning of the
    original rows has written."""
    return IN.uncleaned(_rp(spark, sf), _ledger(spark, sf)).select("id", "url", "title")


def _ledger(spark, sf):
    """The ledger of a cleaning job over the original rows of R+."""
    rows = _rp(spark, sf)
    land = _landing(spark, rows.where(V.is_original(F.col("id"))), "ledger", ["id"])
    out = SJ.scratch(spark, "ledger") + "/clean"
    SJ.clean_stream(spark, land, spark.read.parquet(land).schema, out)
    return SJ.ledger_store(spark, out).read().select("raw_id")


# --------------------------------------------------------------------------
# streaming (X1, X2, X4, X5): each call runs the job to completion with
# trigger(availableNow) into a fresh folder and returns its output table
# --------------------------------------------------------------------------


@query
def stream_daily(spark, sf):
    out = SJ.scratch(spark, "daily")
    schema = read_table(spark, sf, "events").schema
    SJ.daily_counts_stream(spark, sf, schema, out, glob="events.parquet")
    return spark.read.parquet(out)


def _landing(spark, df, name, keys, files=4):
    """Land a frame as parquet files (hash-partitioned on ``keys``: the same
    rows always land in the same files)."""
    path = SJ.scratch(spark, name) + "/landing"
    df.repartition(files, *keys).write.parquet(path)
    return path


@query
def stream_ingest(spark, sf):
    r = V.raw_view(spark, sf)
    land = _landing(spark, _payloads(r), "ingest", ["source", "category"])
    base = SJ.scratch(spark, "ingest")
    feeds = FD.registry(r)
    pages = _page_extract(read_table(spark, sf, "pages"))
    SJ.ingest_stream(spark, land, spark.read.parquet(land).schema, feeds, base + "/state", base + "/raw",
                     pages=pages, collected_at="2024-01-15T09:00:00+09:00", max_files=2)
    raw = spark.read.parquet(base + "/raw")
    return raw.select(*[c for c in raw.columns if c not in ("run", "batch", "raw_json")])


@query
def stream_dedup(spark, sf):
    """X2 over items that come again: every third item lands twice, in files of
    their own, read one by one."""
    items = _items(spark, sf).select(*ITEM_COLUMNS).withColumn("published_ts", F.to_timestamp("published_at"))
    again = items.where(F.pmod("item_pos", F.lit(3)) == 0)
    land = _landing(spark, items.unionAll(again), "dedup", ["source", "category", "feed_no", "item_pos"])
    again.coalesce(1).write.mode("append").parquet(land)
    out = SJ.scratch(spark, "dedup") + "/out"
    SJ.dedup_stream(spark, land, spark.read.parquet(land).schema, out, max_files=2)
    return spark.read.parquet(out).select(*ITEM_COLUMNS)


@query
def stream_clean(spark, sf):
    """X4 in two epochs: the plain raw rows, then their variants."""
    rows, out = _rp(spark, sf), SJ.scratch(spark, "clean") + "/snap"
    land = SJ.scratch(spark, "clean") + "/landing"
    for part in (rows.where(V.is_original(F.col("id"))), rows.where(~V.is_original(F.col("id")))):
        part.repartition(4, "id").write.mode("append").parquet(land)
        SJ.clean_stream(spark, land, rows.schema, out, policy="skip", dedup_similar=True)
    return SJ.clean_store(spark, out).read()


# --------------------------------------------------------------------------
# analysis, digest, summaries, report, health
# --------------------------------------------------------------------------


def _selection(spark, sf, category=CATEGORY):
    return DG.analysis_selection(_a(spark, sf), _s(spark, sf), category=category)


def _selected(spark, sf, category=CATEGORY):
    return DG.selected_articles(_a(spark, sf), _s(spark, sf), category)


@query
def analysis_selection(spark, sf):
    return _selection(spark, sf).select("ordinal", "id", "title", "category", "source", "published_at")


@query
def insight_digest(spark, sf):
    return DG.insight_digest(_selected(spark, sf))


@query
def insight_record(spark, sf):
    return DG.insight_record(DG.insight_digest(_selected(spark, sf)), CATEGORY)


@query
def insight_latest(spark, sf):
    """Two appended records (the category's, then all articles'), stored
    with JSON-text arrays; the newest read back."""
    a, s = _a(spark, sf), _s(spark, sf)
    recs = [DG.insight_record(DG.insight_digest(DG.selected_articles(a, s, cat)), cat)
            .withColumn("id", F.lit(i).cast("long")) for i, cat in enumerate([CATEGORY, None], start=1)]
    table = DG.encode_arrays(recs[0].unionByName(recs[1]))
    return DG.latest_insight(DG.decode_arrays(table))


@query
def selection_digest_text(spark, sf):
    """one listing line for each article of the whole selection."""
    return DG.selection_lines(_selection(spark, sf))


def _targets(spark, sf):
    return AR.summary_targets(_a(spark, sf), _s(spark, sf))


@query
def summaries_built(spark, sf):
    return DG.build_summaries(_targets(spark, sf))


@query
def summary_outcomes(spark, sf):
    """Outcomes of a run over all visible articles, summarised or not."""
    return DG.summary_outcomes(AR.summary_targets(_a(spark, sf), _s(spark, sf), all_=True), _s(spark, sf))


@query
def merge_summary(spark, sf):
    """M2: summaries made anew for all visible articles replace those stored."""
    s = _s(spark, sf).withColumn("v", F.lit(0))
    built = DG.build_summaries(AR.summary_targets(_a(spark, sf), _s(spark, sf), all_=True)).withColumn("v", F.lit(1))
    return M.merge_last_wins(s, built, "article_id", "v").drop("v")


@query
def report_rows(spark, sf):
    """Metrics, counts and keywords."""
    return RP.report_rows(_rp(spark, sf), _a(spark, sf), _s(spark, sf))


@query
def report_full(spark, sf):
    """A17 with the sections of events, their tones and the latest insight."""
    a, s = _a(spark, sf), _s(spark, sf)
    members = _staged_members(spark, sf)
    insight = DG.insight_record(DG.insight_digest(DG.selected_articles(a, s, CATEGORY)), CATEGORY)
    return RP.report_rows(_rp(spark, sf), a, s, EV.events(members, []), EV.tone_verdict(members, []), insight)


@query
def health_metrics(spark, sf):
    return MT.health_metrics(_rp(spark, sf), _ledger(spark, sf), _a(spark, sf), _s(spark, sf), AS_OF)


@query
def health_warnings(spark, sf):
    a, s, rp = _a(spark, sf), _s(spark, sf), _rp(spark, sf)
    h = MT.health_metrics(rp, _ledger(spark, sf), a, s, AS_OF)
    return MT.health_warnings(h, MT.quality_metrics(rp, a, s), run_log=_run_log(rp))


def _run_log(rp):
    """One run for each day of collection, failed if a page failed in it."""
    day = F.substring("collected_at", 1, 10)
    runs = rp.groupBy(day.alias("run_at")).agg(F.count_if(F.col("crawl_status") == "failed").alias("bad"))
    return runs.select("run_at", F.when(F.col("bad") > 0, "failed").otherwise("ok").alias("status"))


@query
def fetch_stats(spark, sf):
    """Feeds read, feeds without items, items saved and body failures per
    source and in total."""
    r = V.raw_view(spark, sf)
    kept, _ = _budgeted(spark, sf)
    out = FD.crawl_outcome(kept, _page_extract(read_table(spark, sf, "pages")))
    return IN.fetch_stats(FD.feed_sizes(_payloads(r)), out)


MODEL = "mock-hash-256"
CACHE_BEFORE = "2024-01-08"     # an earlier run embedded the first week
OTHER_MODEL_DAY = "2024-01-01"  # ... but that day's entries came from another model


def _vector_cache(spark, sf):
    c = _cluster_input(spark, sf).where(F.col("published_at") < F.lit(CACHE_BEFORE).cast("date"))
    v = EV.hash_vectors(c, "id", F.col("text")).join(c.select("id", "published_at"), "id")
    return v.select(F.col("id").alias("article_id"),
                    F.when(F.col("published_at") == F.lit(OTHER_MODEL_DAY).cast("date"), F.lit("other"))
                    .otherwise(F.lit(MODEL)).alias("model"), "idx", "w")


@query
def embed_missing(spark, sf):
    """J5 + V2: per article, where its vector came from and its size."""
    v = EV.vectors_with_cache(_cluster_input(spark, sf), _vector_cache(spark, sf), MODEL)
    return v.groupBy("id", "origin").agg(F.count(F.lit(1)).alias("n_dims"),
                                         F.round(F.sum(F.col("w") * F.col("w")), 6).alias("sq_norm"))


@query
def merge_vectors(spark, sf):
    """M5: the cache after writing back this run's computed vectors."""
    cache = _vector_cache(spark, sf)
    v = EV.vectors_with_cache(_cluster_input(spark, sf), cache, MODEL)
    fresh = EV.cache_rows(v.where(F.col("origin") == "computed"), MODEL)
    m = EV.merge_vectors(cache, fresh)
    return m.groupBy("article_id", "model").agg(F.count(F.lit(1)).alias("n_dims"))


@query
def boilerplate_hits(spark, sf):
    """F2 diagnostics over every document: how many boilerplate patterns
    match the text (personal e-mail lines, bylines, credits, ...)."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", T.boilerplate_hits(F.col("text")).cast("long").alias("hits")) \
        .where(F.col("hits") > 0)


@query
def event_top(spark, sf):
    """V8 display cut: the largest multi-outlet events (size desc, then
    first member: a total order)."""
    return EV.events(_staged_members(spark, sf), [], K.EVENT_MIN_SOURCES) \
        .orderBy(F.col("size").desc(), F.col("cluster")).limit(K.EVENT_TOP_N)


@query
def item_time(spark, sf):
    """S4 over the raw publication texts: UTC ISO time when the text is an
    RFC-822 or ISO date-time, else NULL."""
    r = V.raw_view(spark, sf)
    t = D.item_time(F.col("published_at"))
    return r.select("id", "published_at", F.when(t.isNotNull(), D.iso_utc(t)).alias("item_time"))


@query
def event_components(spark, sf):
    """V6 re-aimed: near-duplicate document groups, linked by the same
    normalised first line or the same whole text (exact copies)."""
    d = read_table(spark, sf, "documents")
    line_key = T.title_key(T.first_line(F.col("text")))
    edges = CC.key_edges(d, "doc_id", {
        "title": F.when(line_key != "", F.sha1(line_key.cast("binary"))),
        "text": F.sha1(F.col("text").cast("binary")),
    })
    return CC.groups(CC.components(edges), min_size=2)


@query
def feed_seen(spark, sf):
    """The seen keys after this run, one row per key."""
    kept, state = _budgeted(spark, sf)
    return IN.next_state(kept, state).keys


@query
def cluster_text(spark, sf):
    """title + (summary, else the body)."""
    j = AR.articles_joined(_a(spark, sf), _s(spark, sf))
    return j.select("id", T.cluster_text(F.col("title"), F.col("summary"), F.col("body")).alias("text"))


@query
def json_arrays(spark, sf):
    """title keyword arrays stored as JSON text and read back
    (NULL or unreadable JSON -> [])."""
    a = _a(spark, sf).select("id", T.keyword_tokens(F.col("title")).alias("keywords"))
    enc = DG.encode_arrays(a, ("keywords",)).select("id", F.col("keywords").alias("keywords_json"),
                                                     F.col("keywords"))
    dec = DG.decode_arrays(enc.select("id", F.col("keywords_json").alias("keywords")), ("keywords",))
    return enc.select("id", "keywords_json").join(dec, "id")
