"""Feed sources: source registry (S5), feed payload text (test/bench feeds
built from raw rows), feed parsing (S1-S4) and extraction outcome (S7).

Payloads are read by one Arrow-batched step over a column of texts (one row
per fetched feed; feed_reader.py), so parsing is as parallel as the payload
table; link, identity and time of the items are decided JVM-side.  A payload
that is no feed yields no items.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.dates import item_time, iso_utc
from ..functions.text import col_
from ..session import small_batches
from .feed_reader import COLUMNS, read_items

ITEMS = ArrayType(StructType([StructField(c, StringType()) for c in COLUMNS]))


@F.pandas_udf(ITEMS)
def items_of(payload: pd.Series) -> pd.Series:
    """The items of each feed text."""
    return payload.map(read_items)


def xml_escape(c: Column | str) -> Column:
    c = F.coalesce(col_(c), F.lit(""))
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def feed_url(source: str, category: str) -> Column:
    return F.concat(F.lit("https://"), F.col(source), F.lit("/rss/"), F.col(category), F.lit(".xml"))


def registry(raw: DataFrame) -> DataFrame:
    """S5 source registry: one row per (source, category) feed with its
    position inside the source (feeds are few per source: a dimension)."""
    feeds = raw.select("source", "category").distinct()
    from pyspark.sql import Window
    w = Window.partitionBy("source").orderBy("category")
    return feeds.select("source", "category",
                        feed_url("source", "category").alias("feed_url"),
                        F.row_number().over(w).cast("long").alias("feed_pos"))


def select_feeds(reg: DataFrame, sources: list[str] | str | None = None, category: str | None = None,
                 seed: int = 0) -> DataFrame:
    """``None`` / "all" = every source, "random" = one source picked
    with ``seed``, a list or "a,b" text = those sources (an unknown name is
    an error); then all feeds or the one category."""
    if isinstance(sources, str):
        if sources in ("", "all"):
            sources = None
        elif sources == "random":
            one = reg.select("source").distinct().orderBy(F.rand(seed)).limit(1)
            return select_feeds(reg.join(one, "source", "left_semi"), None, category)
        else:
            sources = [x.strip() for x in sources.split(",") if x.strip()]
    if sources:
        wanted = list(dict.fromkeys(sources))
        # the check reads back at most len(wanted) names
        found = {r["source"] for r in reg.where(F.col("source").isin(wanted)).select("source").distinct().collect()}
        unknown = [x for x in wanted if x not in found]
        if unknown:
            raise ValueError(f"unknown source(s): {', '.join(unknown)}")
        reg = reg.where(F.col("source").isin(wanted))
    if category:
        reg = reg.where(F.col("category") == category)
    return reg


#: Layouts of the stand-in payloads, by feed number.
LAYOUTS = 4


def feed_payloads(raw: DataFrame, pub_date: Column, iso_date: Column, items_per_feed: int = 50) -> DataFrame:
    """Feed texts built from raw rows: one payload per (source, category,
    id // items_per_feed), items in id order, in one of four layouts by feed
    number: RSS 2.0; Atom; RSS 1.0 with Dublin Core dates; RSS 2.0 with an
    undeclared entity before the items, CDATA titles and a broken tail.  Every
    third item carries no <guid> (identity then falls back to the link).
    Each payload holds at most ``items_per_feed`` items."""
    number = F.floor(F.col("id") / items_per_feed).cast("long")
    layout = F.pmod(number, F.lit(LAYOUTS))

    def el(tag: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))

    def identity(tag: str) -> Column:
        return F.when(F.pmod(F.col("id"), F.lit(3)) != 0, el(tag, xml_escape("guid"))).otherwise(F.lit(""))
    title, url, page = el("title", xml_escape("title")), xml_escape("url"), el("link", xml_escape("url"))
    cdata = F.concat(F.lit("<title><![CDATA["), F.replace(F.coalesce("title", F.lit("")), F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]></title>"))
    rss = F.concat(F.lit("<item>"), title, page, identity("guid"), el("pubDate", pub_date), F.lit("</item>"))
    atom = F.concat(F.lit("<entry>"), title, F.lit('<link rel="self" href="x"/><link href="'), F.replace(url, F.lit('"'), F.lit("&quot;")), F.lit('"/>'),
                    identity("id"), el("published", iso_date), F.lit("</entry>"))
    rdf = F.concat(F.lit("<item>"), title, page, identity("guid"), el("dc:date", iso_date), F.lit("</item>"))
    loose = F.concat(F.lit("<item>"), cdata, page, identity("guid"), el("pubDate", pub_date), F.lit("</item>"))
    item = F.when(layout == 0, rss).when(layout == 1, atom).when(layout == 2, rdf).otherwise(loose)
    g = raw.select("source", "category", number.alias("feed_no"), F.struct(F.col("id"), item.alias("x")).alias("it"))
    agg = g.groupBy("source", "category", "feed_no").agg(F.array_sort(F.collect_list("it")).alias("its"))
    name, xml = xml_escape(F.concat_ws("/", "source", "category")), '<?xml version="1.0" encoding="UTF-8"?>'
    frames = [(xml + '<rss version="2.0"><channel><title>', "</title>", "</channel></rss>"),
              (xml + '<feed xmlns="http://www.w3.org/2005/Atom"><title>', "</title>", "</feed>"),
              (xml + '<rdf:RDF xmlns="http://purl.org/rss/1.0/" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
               'xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>', "</title></channel>", "</rdf:RDF>"),
              ('<rss version="2.0"><channel><title>', "&nbsp;&middot; A & B</title>", "<item><title>cut off</tit")]
    which = F.pmod(F.col("feed_no"), F.lit(LAYOUTS)).cast("int")
    head, middle, tail = (F.element_at(F.array(*[F.lit(f[k]) for f in frames]), which + 1) for k in range(3))
    return agg.select("source", "category", "feed_no", feed_url("source", "category").alias("feed_url"),
                      F.concat(head, name, middle, F.array_join(F.col("its.x"), ""), tail).alias("payload"))


def parse_feed(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Payload rows (source, category, feed_url?, payload) -> item rows.

    S2 items without a link are dropped, link and title trimmed; S3 identity
    = first non-empty of id, guid, link, else title; S4 time = published
    else updated, as UTC ISO text (NULL when unreadable).  ``raw_json`` holds
    the item as it came, with the feed's address where the payload has one.
    """
    keep = [c for c in payloads.columns if c not in (payload_col, "feed_url")]
    address = F.col("feed_url") if "feed_url" in payloads.columns else F.lit(None).cast("string")
    parsed = small_batches(payloads).select(*keep, address.alias("__feed"), items_of(F.col(payload_col)).alias("__items"))
    parsed = parsed.select(*keep, "__feed", F.posexplode("__items").alias("item_pos", "i"))
    link = F.trim(F.col("i.link"))
    t = item_time(F.col("i.published"), F.col("i.updated"))
    guid = F.coalesce(*[F.when(F.trim(F.col(f"i.{c}")) != "", F.col(f"i.{c}")) for c in ("id", "guid", "link")],
                      F.coalesce(F.col("i.title"), F.lit("")))
    return parsed.where(F.coalesce(link, F.lit("")) != "").select(
        *keep, F.col("item_pos").cast("long").alias("item_pos"),
        F.lit("rss").alias("method"), guid.alias("guid"), link.alias("url"),
        F.trim(F.coalesce(F.col("i.title"), F.lit(""))).alias("title"),
        F.when(t.isNotNull(), iso_utc(t)).alias("published_at"),
        F.to_json(F.struct(F.col("__feed").alias("feed_url"), F.col("i.title").alias("title"), F.col("i.link").alias("link"),
                           F.col("i.author").alias("author"), F.coalesce("i.published", "i.updated").alias("published"),
                           F.col("i.summary").alias("summary"))).alias("raw_json"))


def feed_sizes(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """(source, category, n_items) of each feed text; 0 for one that is no feed."""
    n = F.when(F.col(payload_col).isNull(), 0).otherwise(F.size(items_of(F.col(payload_col))))
    return small_batches(payloads).select("source", "category", n.cast("long").alias("n_items"))


def crawl_outcome(items: DataFrame, extracted: DataFrame | None) -> DataFrame:
    """Join items to extracted pages on url.  Body found -> 'ok' and the
    feed title preferred over the page title; none -> 'failed'; extraction
    disabled (``extracted`` is None) -> 'skipped' with method 'rss'.  A url
    that was fetched more than once counts once (the least page with a body, by
    title and body), so items never multiply."""
    if extracted is None:
        return items.select("*", F.lit(None).cast("string").alias("body"),
                            F.lit("skipped").alias("crawl_status")).withColumn("method", F.lit("rss"))
    page = F.struct((F.coalesce(F.col("body"), F.lit("")) == "").alias("e"), F.col("title").alias("t"), F.col("body").alias("b"))
    # texts of other urls go before the rest moves
    mine = extracted.join(items.select(F.col("url").alias("_u")).distinct(), F.col("url") == F.col("_u"), "left_semi")
    x = mine.groupBy(F.col("url").alias("_u")).agg(F.min(page).alias("_p"))
    x = x.select("_u", F.col("_p.t").alias("_pt"), F.col("_p.b").alias("_pb"))
    j = items.join(x, items["url"] == x["_u"], "left")
    found = F.coalesce(F.col("_pb"), F.lit("")) != ""
    return j.select(
        *[c for c in items.columns if c not in ("title", "method")],
        F.lit("rss+crawl").alias("method"),
        F.when(found, F.coalesce(F.when(F.col("title") != "", F.col("title")), F.col("_pt")))
        .otherwise(F.col("title")).alias("title"),
        F.when(found, F.col("_pb")).alias("body"),
        F.when(found, F.lit("ok")).otherwise(F.lit("failed")).alias("crawl_status"))
