"""S6 page extraction checked against an independent stdlib HTML parser
(element removal, first h1 / article, stripped text nodes joined by one
space, entities decoded)."""

from html.parser import HTMLParser

import pytest

from articleflow.sources.pages import page_extract

REMOVE = {"script", "style", "figure", "aside", "nav"}


class _Extract(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.removed = 0
        self.stack = []
        self.nodes = {"h1": None, "article": None}
        self.open = {"h1": 0, "article": 0}

    def handle_starttag(self, tag, attrs):
        if tag in REMOVE:
            self.removed += 1
        for t in self.nodes:
            if tag == t and self.removed == 0 and self.nodes[t] is None:
                self.nodes[t] = []
                self.open[t] = 1
            elif tag == t and self.open[t]:
                self.open[t] += 1

    def handle_endtag(self, tag):
        if tag in REMOVE and self.removed:
            self.removed -= 1
        for t in self.nodes:
            if tag == t and self.open[t]:
                self.open[t] -= 1

    def handle_data(self, data):
        if self.removed:
            return
        for t in self.nodes:
            if self.open[t]:
                self.nodes[t].append(data)


def reference(html):
    p = _Extract()
    p.feed(html)
    out = []
    for t in ("h1", "article"):
        nodes = p.nodes[t] or []
        text = " ".join(s.strip() for s in nodes if s.strip())
        out.append(text or None)
    return tuple(out)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_page_extract_matches_parser(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r["page_id"]: reference(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: (r["title"], r["body"]) for r in page_extract(pages).collect()}
    assert got == want


def test_selectors_and_meta(spark):
    html = ("<html><head><meta property='og:title' content='Meta &amp; title'></head><body>"
            "<div class='x article-body y'><p>one</p><script>bad()</script><p> two </p></div>"
            "<div id='other'>zzz</div></body></html>")
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    r = page_extract(df).first()
    assert r["title"] == "Meta & title"
    assert r["body"] == "one two"


def _one(html, **how):
    from articleflow.sources.markup import extract, wanted
    lists = (tuple(how.get("title", ("h1",))), tuple(how.get("body", ("article",))))
    return extract(html, wanted(tuple(how.get("remove", ("script", "style", "aside"))), lists))


@pytest.mark.parametrize("html,how,want", [
    ('<div class="article-body"><div>AD</div><p>REAL</p></div>after', {"body": (".article-body",)}, "AD REAL"),
    ('<div id=a><div><div>x</div></div>y</div>z', {"body": ("#a",)}, "x y"),
    ('<aside>a<aside>b</aside>c</aside><article>real</article>', {}, "real"),
    ('<article>one<aside>a<div>b</aside> two</article>', {}, "one two"),
    ('<section><div><p>deep</p></div></section><div><p>no</p></div>', {"body": ("section > p", "section p")}, "deep"),
    ('<div><p>a</p></div><section><p>b</p></section>', {"body": ("section > p",)}, "b"),
    ('<p itemprop="articleBody x">t</p>', {"body": ("[itemprop=articleBody]", "[itemprop~='articleBody']")}, "t"),
    ('<div data-k="ab-cd">t</div>', {"body": ("div[data-k|=ab]",)}, "t"),
    ('<div data-k="ab-cd">t</div>', {"body": ("div[data-k^='ab'][data-k$=cd][data-k*='-']",)}, "t"),
    ('<div class="a b">x</div><div class="b c a">y</div>', {"body": ("div.a.c",)}, "y"),
    ('<i>x</i><b>y</b>', {"body": ("u, b",)}, "y"),
    ('<article></article><div class=x>t</div>', {"body": ("article", ".x")}, "t"),
    ('<article>  </article><article>second</article>', {}, None),
    ('<article>a &amp; b &lt;c&gt; &nbsp; <b>d</b>&eacute;</article>', {}, "a & b <c> d é"),
    ('<article title="a > b">x <!-- <p>no --> y</article>', {}, "x y"),
    ("<article class=it's>x</article> it's", {}, "x"),
    ('<article>1 < 2 and <script>if (a < b) "</p>"</script>3', {}, "1 < 2 and 3"),
    ('<ARTICLE>Up<BR>per</ARTICLE>', {}, "Up per"),
    ('<article><p>one<p>two<ul><li>a<li>b</ul></article>out', {}, "one two a b"),
    ('<p class=k>one<div>no</div>', {"body": ("p.k",)}, "one"),
    ('<table><tr><td id=c>x<td>y</table>', {"body": ("#c",)}, "x"),
    ('</div><article>x</b></article>', {}, "x"),
    ('<article>open <b>to the end', {}, "open to the end"),
    ('', {}, None),
])
def test_nested_and_broken_pages(html, how, want):
    assert _one(html, **how)[1] == want


def test_meta_falls_through_when_empty():
    html = "<meta property='og:title' content=' '><h1>T</h1><article>x</article>"
    assert _one(html, title=("meta[property='og:title']", "h1")) == ["T", "x"]


@pytest.mark.parametrize("selector", ["p:first-child", "p + p", "", "> p", "p,,b", "a ~ b"])
def test_unsupported_selectors_raise(spark, selector):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    with pytest.raises(ValueError):
        page_extract(df, body_selectors=(selector,))


def test_selectors_by_source(spark):
    """Two sites with their own lists, a third by the defaults; null pages."""
    from articleflow.functions.urls import url_host
    from articleflow.sources.pages import with_extracted
    from pyspark.sql import functions as F

    page = "<h1 class='tit'>A</h1><h1>B</h1><div class='story'><div class='ad'>AD</div><div>S</div></div><article>C</article>"
    df = spark.createDataFrame([(1, "https://one.ex/x", page), (2, "https://two.ex/x", page), (3, "https://three.ex/x", page), (4, "https://one.ex/y", None)],
                               "page_id long, url string, html string")
    rules = spark.createDataFrame([("one.ex", ["h1.tit"], ["div.story"], [".ad"]), ("two.ex", None, ["div.story", "article"], None)],
                                  "source string, title_selectors array<string>, body_selectors array<string>, remove_selectors array<string>")
    got = with_extracted(df, by_source=rules, source=url_host(F.col("url")))
    assert got.columns == ["page_id", "url", "title", "body", "body_found"]
    assert sorted(map(tuple, got.select("page_id", "title", "body", "body_found").collect())) == [
        (1, "A", "S", True), (2, "A", "AD S", True), (3, "A", "C", True), (4, None, None, False)]


def test_batches_of_pages_are_bounded(spark):
    """A Python worker gets few pages at a time, whatever the session had."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 30))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    df = spark.createDataFrame([(1, "https://a.example/x", "<h1>t</h1><article>b</article>")], "page_id long, url string, html string")
    assert page_extract(df).collect()[0]["body"] == "b"
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
