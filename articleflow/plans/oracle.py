"""DuckDB SQL oracle for the named queries.

Written independently of the Spark code (window functions where Spark uses
aggregates, unnest + running sums where Spark folds arrays).  Tables are
the driver's views: documents, pages, labels, ...

Known identities on the test data (checked by tests): NFKC and entity
decoding change nothing in the extracted page text beyond the entities the
SQL decodes itself, and no query value is percent-encoded, so the SQL side
leaves those two steps out.
"""

from __future__ import annotations

from .. import constants as K
from ..functions.dates import COMPACT, MONTHS, RFC822, YMD_RUN
from ..functions.text import WS
from ..functions.urls import _SPLIT
from . import catalog as Q


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SEP = "chr(1)"
STOP = "[" + ", ".join(lit(w) for w in K.STOPWORDS) + "]"


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def title_hash(x: str) -> str:
    return f"sha1(lower(regexp_replace(coalesce({x}, ''), {lit(K.TITLE_HASH_DROP)}, '', 'g')))"


def day_of(idc: str) -> str:
    return f"CAST(DATE '2024-01-01' + CAST({idc} % 14 AS INTEGER) AS DATE)"


# --------------------------------------------------------------------------
# A, S
# --------------------------------------------------------------------------
A_CTE = f"""
a0 AS (
  SELECT doc_id AS id,
         'https://' || source || '.example/' || CAST(doc_id AS VARCHAR) AS url,
         split_part(text, chr(10), 1) AS title,
         {title_hash("split_part(text, chr(10), 1)")} AS title_hash,
         lower(regexp_replace(split_part(text, chr(10), 1), {lit(K.TITLE_HASH_DROP)}, '', 'g')) = '' AS empty_key,
         text AS body, lang AS category, source,
         {day_of("doc_id")} AS published_at
  FROM documents),
a AS (
  SELECT id, url, title, title_hash, body, category, source, published_at,
         (row_number() OVER (PARTITION BY title_hash ORDER BY id) > 1 AND NOT empty_key) AS is_duplicate
  FROM a0)"""


def sentence_split(x: str) -> str:
    return (f"string_split(regexp_replace({trim_ws(x)}, {lit('([.!?。])' + WS + '+')}, "
            f"'\\1' || {SEP}, 'g'), {SEP})")


def summary_ctes(src: str, key: str, text: str, prefix: str, max_chars: int = K.SUMMARY_MAX_CHARS) -> str:
    """CTEs ``{prefix}_sum(key, summary)`` for an extractive summary."""
    return f"""
{prefix}_sp AS (
  SELECT {key} AS k, {text} AS body, {sentence_split(text)} AS sents FROM {src}),
{prefix}_ux AS (
  SELECT k, unnest(sents) AS s, unnest(generate_series(1, len(sents))) AS pos FROM {prefix}_sp),
{prefix}_cum AS (
  SELECT k, pos, sum(length(s) + 1) OVER (PARTITION BY k ORDER BY pos) - 1 AS run FROM {prefix}_ux),
{prefix}_k AS (
  SELECT k, count(*) FILTER (WHERE run <= {max_chars}) AS n_keep FROM {prefix}_cum GROUP BY k),
{prefix}_sum AS (
  SELECT sp.k,
         {trim_ws(lit(K.SUMMARY_PREFIX) + " || CASE WHEN kk.n_keep > 0 THEN " +
                  trim_ws("array_to_string(sp.sents[1:kk.n_keep], ' ')") +
                  f" ELSE {trim_ws(f'substr(sp.body, 1, {max_chars})')} END")} AS summary
  FROM {prefix}_sp sp JOIN {prefix}_k kk ON sp.k = kk.k)"""


S_CTE = f"""
sl AS (SELECT d.doc_id, d.text, l.toxic, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
{summary_ctes("sl", "doc_id", "text", "ss")},
s AS (
  SELECT sl.doc_id AS article_id, ss_sum.summary, CAST(length(sl.text) AS BIGINT) AS orig_len,
         CAST(length(ss_sum.summary) AS BIGINT) AS summary_len,
         CASE WHEN sl.toxic = 1 THEN 'negative' WHEN sl.quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
         'mock' AS model
  FROM sl JOIN ss_sum ON sl.doc_id = ss_sum.k)"""

AS_CTE = f"WITH {A_CTE},{S_CTE}"
A_ONLY = f"WITH {A_CTE}"

# --------------------------------------------------------------------------
# R, R+
# --------------------------------------------------------------------------


def unescape(x: str) -> str:
    """Entities that occur in the test pages; the legacy forms may omit the
    ';' (HTML5).  '&amp' goes last so that decoded '&' never forms a new
    entity."""
    out = x
    for ent, ch in (("&quot;?", '"'), ("&#39;?", "'"), ("&apos;", "'"), ("&lt;?", "<"), ("&gt;?", ">"),
                    ("&nbsp;?", "\u00a0"), ("&amp;?", "&")):
        out = f"regexp_replace({out}, {lit(ent)}, {lit(ch)}, 'g')"
    return out


def node_text(frag: str) -> str:
    nodes = f"string_split(regexp_replace({frag}, '<[^>]*>', {SEP}, 'g'), {SEP})"
    return (f"array_to_string(list_filter(list_transform({nodes}, lambda x: {trim_ws(unescape('x'))}), "
            f"lambda x: x <> ''), ' ')")


def _strip_elements(h: str) -> str:
    h = f"regexp_replace({h}, '(?s)<!--.*?-->', {SEP}, 'g')"
    for tag in ("script", "style", "figure", "aside", "nav"):
        h = f"regexp_replace({h}, {lit('(?is)<' + tag + r'\b[^>]*>.*?</' + tag + r'\s*>')}, {SEP}, 'g')"
    return h


def url_part(url: str, i: int) -> str:
    return f"regexp_extract({url}, {lit(_SPLIT)}, {i})"


PX_CTE = f"""
px0 AS (SELECT page_id, url, {_strip_elements("html")} AS h FROM pages),
px AS (
  SELECT page_id, url,
         nullif({node_text("regexp_extract(h, " + lit(r"(?is)<h1\b[^>]*>(.*?)</h1\s*>") + ", 1)")}, '') AS title,
         nullif({node_text("regexp_extract(h, " + lit(r"(?is)<article\b[^>]*>(.*?)</article\s*>") + ", 1)")}, '') AS body
  FROM px0)"""

R_CTE = PX_CTE + f""",
r AS (
  SELECT page_id AS id,
         lower(regexp_extract({url_part("url", 2)}, '^(?:[^@]*@)?([^:]*)', 1)) AS source,
         'rss+crawl' AS method, url AS guid, url, title, body,
         regexp_extract({url_part("url", 3)}, '^/([^/]*)', 1) AS category,
         CASE page_id % 5
           WHEN 0 THEN strftime({day_of("page_id")}, '%Y-%m-%d') || 'T10:00:00+09:00'
           WHEN 1 THEN strftime({day_of("page_id")}, '%a, %d %b %Y') || ' 10:00:00 +0900'
           WHEN 2 THEN strftime({day_of("page_id")}, '%Y.%m.%d')
           WHEN 3 THEN strftime({day_of("page_id")}, '%Y/%m/%d')
         END AS published_at,
         CASE WHEN coalesce(body, '') <> '' THEN 'ok' ELSE 'failed' END AS crawl_status,
         strftime({day_of("page_id")} + 1, '%Y-%m-%d') || 'T09:00:00+09:00' AS collected_at
  FROM px)"""

RP_CTE = R_CTE + """,
rp AS (
  SELECT id * 4 AS id, source, method, guid, url, title, body, category, published_at, crawl_status, collected_at FROM r
  UNION ALL
  SELECT id * 4 + 1, source, method, guid,
         CASE WHEN strpos(regexp_extract(url, '^([^#]*)', 1), '?') > 0
              THEN regexp_extract(url, '^([^#]*)', 1) || '&utm_source=copy'
              ELSE regexp_extract(url, '^([^#]*)', 1) || '?utm_source=copy' END
           || regexp_extract(url, '(#.*)$', 1),
         title || ' v2', body, category, published_at, crawl_status, collected_at
  FROM r WHERE id % 5 = 0
  UNION ALL
  SELECT id * 4 + 2, source, method, guid,
         'https://' || source || '/' || category || '/story-' || CAST(id AS VARCHAR),
         title, body, category, published_at, crawl_status, collected_at
  FROM r WHERE id % 7 = 0
  UNION ALL
  SELECT id * 4 + 3, source, method, guid,
         CASE WHEN id % 50 = 1 THEN '' ELSE url END,
         CASE WHEN id % 50 = 2 THEN '' ELSE title END,
         CASE WHEN id % 50 = 3 THEN '' WHEN id % 50 = 4 THEN substr(body, 1, 60) ELSE body END,
         category, published_at,
         CASE WHEN id % 50 = 3 THEN 'failed' ELSE crawl_status END, collected_at
  FROM r WHERE id % 50 BETWEEN 1 AND 4)"""


# --------------------------------------------------------------------------
# clean functions in SQL
# --------------------------------------------------------------------------
def normalize_text(x: str, boiler: bool) -> str:
    v = f"regexp_replace(coalesce({x}, ''), {lit(K.HTML_TAG)}, ' ', 'g')"
    if boiler:
        for p in K.BOILERPLATE_PATTERNS:
            v = f"regexp_replace({v}, {lit(p)}, ' ', 'g')"
    v = f"regexp_replace({v}, {lit(K.BLANK_RUN)}, ' ', 'g')"
    v = f"regexp_replace({v}, {lit(chr(10) + '{3,}')}, {lit(chr(10) * 2)}, 'g')"
    return trim_ws(v)


def normalize_url(u: str) -> str:
    t = f"regexp_replace({trim_ws(f'coalesce({u}, {lit(chr(39) * 0)})')}, '[\\t\\r\\n]', '', 'g')"
    scheme = f"lower({url_part(t, 1)})"
    netloc = url_part(t, 2)
    path = f"regexp_replace({url_part(t, 3)}, '/+$', '')"
    query = url_part(t, 4)
    trk = "[" + ", ".join(lit(p) for p in K.TRACKING_PARAMS) + "]"
    q = (f"array_to_string(list_filter(string_split({query}, '&'), lambda p: strpos(p, '=') > 0 "
         f"AND strpos(p, '=') < length(p) AND NOT list_contains({trk}, split_part(p, '=', 1))), '&')")
    has_net = f"(regexp_matches({t}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//') OR {netloc} <> '')"
    return (f"(CASE WHEN {scheme} <> '' THEN {scheme} || ':' ELSE '' END"
            f" || CASE WHEN {has_net} THEN '//' || lower({netloc}) ELSE '' END"
            f" || CASE WHEN {path} = '' THEN '/' ELSE {path} END"
            f" || CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END)")


def _ymd(y: str, m: str, d: str) -> str:
    return f"TRY_CAST(lpad({y}, 4, '0') || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"


def _day_of_text(t: str) -> str:
    run = _ymd(f"regexp_extract({t}, {lit(YMD_RUN)}, 1)", f"regexp_extract({t}, {lit(YMD_RUN)}, 2)",
               f"regexp_extract({t}, {lit(YMD_RUN)}, 3)")
    mon = "CASE lower(regexp_extract(" + t + ", " + lit(RFC822) + ", 2)) " + " ".join(
        f"WHEN {lit(m)} THEN '{i}'" for i, m in enumerate(MONTHS, start=1)) + " END"
    rfc = _ymd(f"regexp_extract({t}, {lit(RFC822)}, 3)", mon, f"regexp_extract({t}, {lit(RFC822)}, 1)")
    cmp_ = _ymd(f"regexp_extract({t}, {lit(COMPACT)}, 1)", f"regexp_extract({t}, {lit(COMPACT)}, 2)",
                f"regexp_extract({t}, {lit(COMPACT)}, 3)")
    return (f"coalesce(CASE WHEN regexp_matches({t}, {lit(YMD_RUN)}) THEN {run} END, "
            f"CASE WHEN regexp_matches({t}, {lit(RFC822)}) THEN {rfc} END, "
            f"CASE WHEN regexp_matches({t}, {lit(COMPACT)}) THEN {cmp_} END)")


def normalize_date(v: str, fb: str) -> str:
    return (f"coalesce({_day_of_text(trim_ws(f'coalesce({v}, {lit(chr(39) * 0)})'))}, "
            f"{_day_of_text(trim_ws(f'coalesce({fb}, {lit(chr(39) * 0)})'))})")


V_CTE = RP_CTE + f""",
vn AS (
  SELECT id AS raw_id, {trim_ws("coalesce(url, '')")} AS u,
         {normalize_text("title", False)} AS title, {normalize_text("body", True)} AS body,
         category, source, published_at AS pub, collected_at
  FROM rp),
v AS (
  SELECT raw_id,
         CASE WHEN u = '' THEN 'no_url' WHEN title = '' THEN 'no_title' WHEN body = '' THEN 'no_body'
              WHEN length(body) < {K.MIN_BODY} THEN 'short_body' ELSE 'ok' END AS reason,
         CAST(length(body) AS BIGINT) AS body_len,
         {normalize_url("u")} AS url, title, {title_hash("title")} AS title_hash, body,
         coalesce(nullif(category, ''), {lit(K.DEFAULT_CATEGORY)}) AS category,
         coalesce(nullif(source, ''), {lit(K.DEFAULT_SOURCE)}) AS source,
         {normalize_date("pub", "collected_at")} AS published_at
  FROM vn),
ok AS (SELECT raw_id, url, title, title_hash, body, category, source, published_at FROM v WHERE reason = 'ok'),
w1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id) AS rn FROM ok) WHERE rn = 1),
w3 AS (
  SELECT raw_id, url, title, title_hash, body, category, source, published_at,
         (row_number() OVER (PARTITION BY title_hash ORDER BY raw_id) > 1
          AND title_hash <> '{"da39a3ee5e6b4b0d3255bfef95601890afd80709"}') AS is_duplicate
  FROM w1)"""

CLEAN_COLS = "raw_id, url, title, title_hash, body, category, source, published_at"

SQL: dict[str, str] = {}

# keywords and trends --------------------------------------------------------
_TOK = f"""
vis AS (SELECT * FROM a WHERE NOT is_duplicate),
tok AS (
  SELECT id, published_at, t AS token
  FROM (SELECT id, published_at, unnest(regexp_extract_all(coalesce(title, ''), {lit(K.KEYWORD_PATTERN)})) AS t FROM vis)
  WHERE NOT list_contains({STOP}, t) AND length(t) >= 2),
days AS (SELECT DISTINCT published_at AS day FROM vis WHERE published_at IS NOT NULL),
win AS (SELECT day, CAST(row_number() OVER (ORDER BY day DESC) AS BIGINT) AS pos FROM days),
w AS (SELECT * FROM win WHERE pos <= {K.TREND_DAYS}),
dk AS (
  SELECT published_at AS day, token, count(*) AS n FROM tok
  WHERE published_at IN (SELECT day FROM w) GROUP BY 1, 2),
meta AS (SELECT max(day) AS today, count(*) AS n_days FROM w),
bc AS (
  SELECT meta.today, token,
         CAST(sum(CASE WHEN day = meta.today THEN n ELSE 0 END) AS BIGINT) AS today_n,
         CAST(sum(CASE WHEN day < meta.today THEN n ELSE 0 END) AS BIGINT) AS prior_total,
         CAST(greatest(meta.n_days - 1, 1) AS BIGINT) AS prior_days
  FROM dk, meta GROUP BY meta.today, token, meta.n_days)"""

SQL["top_keywords"] = f"""{A_ONLY},{_TOK}
SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token ASC LIMIT {K.TOP_N}"""

SQL["daily_keywords"] = f"{A_ONLY},{_TOK}\nSELECT day, token, n FROM dk"
SQL["trend_window"] = f"{A_ONLY},{_TOK}\nSELECT day, pos FROM w"
SQL["trend_top_today"] = f"""{A_ONLY},{_TOK}
SELECT today, token, today_n FROM bc WHERE today_n > 0 ORDER BY today_n DESC, token ASC LIMIT {K.TOP_N}"""
SQL["trend_new"] = f"""{A_ONLY},{_TOK}
SELECT today, token, today_n FROM bc WHERE today_n >= 2 AND prior_total = 0
ORDER BY today_n DESC, token ASC LIMIT {K.TOP_N}"""
SQL["trend_rising"] = f"""{A_ONLY},{_TOK}
SELECT today, token, today_n, prior_total, prior_days, round(prior_total / prior_days, 6) AS prior_avg
FROM bc WHERE today_n >= 2 AND prior_total > 0 AND today_n >= (prior_total / prior_days) * 1.5
  AND today_n - (prior_total / prior_days) >= 1
ORDER BY today_n DESC, token ASC LIMIT {K.TOP_N}"""
SQL["keyword_timeline"] = f"""{A_ONLY},{_TOK},
top AS (SELECT token FROM dk GROUP BY token ORDER BY sum(n) DESC, token ASC LIMIT {max(K.TOP_N, 6)})
SELECT w.day, top.token, CAST(coalesce(dk.n, 0) AS BIGINT) AS n
FROM w CROSS JOIN top LEFT JOIN dk ON dk.day = w.day AND dk.token = top.token"""

# scalar layer -------------------------------------------------------------------
SQL["title_hash"] = f"SELECT doc_id, {title_hash('split_part(text, chr(10), 1)')} AS title_hash FROM documents"
SQL["keyword_tokens"] = f"""{A_ONLY}
SELECT id, CAST(pos - 1 AS BIGINT) AS pos, token FROM (
  SELECT id, unnest(toks) AS token, unnest(generate_series(1, len(toks))) AS pos FROM (
    SELECT id, list_filter(regexp_extract_all(coalesce(title, ''), {lit(K.KEYWORD_PATTERN)}),
                           lambda t: NOT list_contains({STOP}, t) AND length(t) >= 2) AS toks FROM a))"""
SQL["url_normalized"] = f"SELECT page_id, url, {normalize_url('url')} AS norm_url FROM pages"
SQL["date_normalized"] = f"""WITH {R_CTE}
SELECT id, published_at, collected_at, {normalize_date('published_at', 'collected_at')} AS day FROM r"""
SQL["page_extract"] = f"WITH {PX_CTE}\nSELECT page_id, title, body FROM px"
SQL["text_normalized"] = f"""WITH {R_CTE}
SELECT id, {normalize_text('title', False)} AS title, {normalize_text('body', True)} AS body FROM r"""
SQL["extractive_summary"] = f"""WITH {summary_ctes("documents", "doc_id", "text", "es")}
SELECT k AS doc_id, summary, CAST(length(summary) AS BIGINT) AS summary_len FROM es_sum"""


def _hint_count(words, t: str) -> str:
    return " + ".join(f"CAST(strpos({t}, {lit(w)}) > 0 AS INTEGER)" for w in words)


SQL["lexicon_sentiment"] = f"""{A_ONLY}
SELECT id, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS sentiment FROM (
  SELECT id, {_hint_count(Q.LATIN_POSITIVE, "(title || body)")} AS p,
         {_hint_count(Q.LATIN_NEGATIVE, "(title || body)")} AS n FROM a)"""

_ALIAS = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in K.LABEL_ALIASES.items())
_DISP = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in K.LABEL_DISPLAY.items())
_SPELLED = ", ".join("NULL" if x is None else lit(x) for x in Q.SPELLINGS)
SQL["label_normalized"] = f"""{AS_CTE},
sp AS (SELECT article_id, ([{_SPELLED}])[article_id % {len(Q.SPELLINGS)} + 1] AS sentiment FROM s)
SELECT article_id,
  CASE WHEN sentiment IS NULL OR sentiment = '' THEN 'neutral'
       WHEN lower({trim_ws('sentiment')}) IN ('positive', 'negative', 'neutral') THEN lower({trim_ws('sentiment')})
       ELSE coalesce(CASE lower({trim_ws('sentiment')}) {_ALIAS} END, 'neutral') END AS label,
  coalesce(CASE coalesce(sentiment, 'unknown') {_DISP} END, {lit(K.DISPLAY_UNCLASSIFIED)}) AS display
FROM sp"""

# clean path -------------------------------------------------------------------
SQL["clean_valid"] = f"WITH {V_CTE}\nSELECT {CLEAN_COLS} FROM ok"
SQL["reject_reasons"] = f"""WITH {V_CTE}
SELECT reason, CASE WHEN reason = 'short_body' THEN body_len END AS short_len, count(*) AS n
FROM v WHERE reason <> 'ok' GROUP BY 1, 2"""
SQL["dedup_skip"] = f"WITH {V_CTE}\nSELECT {CLEAN_COLS} FROM w1"
SQL["dedup_upsert"] = f"""WITH {V_CTE},
lw AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id DESC) AS rn,
              min(raw_id) OVER (PARTITION BY url) AS first_id FROM ok)
SELECT first_id AS id, {CLEAN_COLS} FROM lw WHERE rn = 1"""
SQL["similar_flag"] = f"WITH {V_CTE}\nSELECT {CLEAN_COLS}, is_duplicate FROM w3"
SQL["clean_stats"] = f"""WITH {V_CTE},
tagged AS (
  SELECT ok.raw_id, CASE WHEN w3.raw_id IS NOT NULL THEN 'inserted' ELSE 'skipped' END AS outcome,
         coalesce(w3.is_duplicate, false) AS sim
  FROM ok LEFT JOIN w3 ON ok.raw_id = w3.raw_id
  UNION ALL
  SELECT raw_id, 'invalid', false FROM v WHERE reason <> 'ok')
SELECT outcome, count(*) AS n FROM tagged GROUP BY outcome
UNION ALL
SELECT 'similar', count(*) FROM tagged WHERE sim"""

_STORE = f""",
st_ok AS (SELECT * FROM ok WHERE raw_id % 4 = 0),
st1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id) AS rn FROM st_ok) WHERE rn = 1),
store AS (
  SELECT raw_id AS id, {CLEAN_COLS},
         (row_number() OVER (PARTITION BY title_hash ORDER BY raw_id) > 1
          AND title_hash <> 'da39a3ee5e6b4b0d3255bfef95601890afd80709') AS is_duplicate
  FROM st1),
batch AS (SELECT * FROM ok WHERE raw_id % 4 <> 0),
bfirst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id) AS rn FROM batch) WHERE rn = 1),
bnew AS (SELECT * FROM bfirst WHERE url NOT IN (SELECT url FROM store)),
held AS (SELECT DISTINCT title_hash FROM store WHERE NOT is_duplicate),
ins AS (
  SELECT raw_id AS id, {CLEAN_COLS},
         ((row_number() OVER (PARTITION BY title_hash ORDER BY raw_id) > 1 OR title_hash IN (SELECT title_hash FROM held))
          AND title_hash <> 'da39a3ee5e6b4b0d3255bfef95601890afd80709') AS is_duplicate
  FROM bnew)"""

SQL["merge_clean"] = f"""WITH {V_CTE}{_STORE}
SELECT id, is_duplicate, {CLEAN_COLS}, 'kept' AS outcome FROM store
UNION ALL
SELECT id, is_duplicate, {CLEAN_COLS}, 'inserted' FROM ins"""

SQL["merge_clean_upsert"] = f"""WITH {V_CTE}{_STORE},
blast AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id DESC) AS rn FROM batch) WHERE rn = 1)
SELECT st.id, st.is_duplicate,
       CASE WHEN b.url IS NULL THEN st.raw_id ELSE b.raw_id END AS raw_id, st.url,
       CASE WHEN b.url IS NULL THEN st.title ELSE b.title END AS title,
       CASE WHEN b.url IS NULL THEN st.title_hash ELSE b.title_hash END AS title_hash,
       CASE WHEN b.url IS NULL THEN st.body ELSE b.body END AS body,
       CASE WHEN b.url IS NULL THEN st.category ELSE b.category END AS category,
       CASE WHEN b.url IS NULL THEN st.source ELSE b.source END AS source,
       CASE WHEN b.url IS NULL THEN st.published_at ELSE b.published_at END AS published_at,
       CASE WHEN b.url IS NULL THEN 'kept' ELSE 'updated' END AS outcome
FROM store st LEFT JOIN blast b ON st.url = b.url
UNION ALL
SELECT ins.id, ins.is_duplicate, b.raw_id, b.url, b.title, b.title_hash, b.body, b.category, b.source,
       b.published_at, 'inserted'
FROM ins JOIN blast b ON ins.url = b.url"""

# read path ----------------------------------------------------------------------
_J = """
j AS (
  SELECT a.id, a.url, a.title, a.title_hash, a.body, a.category, a.source, a.published_at, a.is_duplicate,
         s.summary, s.sentiment, s.orig_len, s.summary_len, s.article_id IS NOT NULL AS summarized
  FROM a LEFT JOIN s ON s.article_id = a.id)"""
_JCOLS = ("id, url, title, title_hash, body, category, source, published_at, is_duplicate, "
          "summary, sentiment, orig_len, summary_len")


def _read(where: str) -> str:
    return f"{AS_CTE},{_J}\nSELECT {_JCOLS} FROM j WHERE {where}"


SQL["articles_joined"] = f"{AS_CTE},{_J}\nSELECT {_JCOLS} FROM j"
SQL["q_by_id"] = _read(f"id = {Q.ARTICLE_ID} AND NOT is_duplicate")
SQL["q_category"] = _read(f"category = {lit(Q.CATEGORY)} AND NOT is_duplicate")
SQL["q_source"] = _read(f"source = {lit(Q.SOURCE)} AND NOT is_duplicate")
SQL["q_day"] = _read(f"published_at = DATE '{Q.DAY}' AND NOT is_duplicate")
SQL["q_date_range"] = _read(
    f"published_at >= DATE '{Q.DATE_FROM}' AND published_at <= DATE '{Q.DATE_TO}' AND NOT is_duplicate")
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%{}%'"
SQL["q_keyword"] = _read(f"({_FOLD.format('title', Q.KEYWORD.lower())} OR {_FOLD.format('body', Q.KEYWORD.lower())})"
                         " AND NOT is_duplicate")
SQL["q_summarized"] = _read("summarized AND NOT is_duplicate")
SQL["q_unsummarized"] = _read("NOT summarized AND NOT is_duplicate")
SQL["q_no_dups"] = _read("NOT is_duplicate")
SQL["article_page"] = f"""{AS_CTE},{_J},
f AS (SELECT {_JCOLS} FROM j WHERE category = {lit(Q.CATEGORY)} AND NOT is_duplicate),
t AS (SELECT count(*) AS total FROM f)
SELECT f.*, CAST(3 AS BIGINT) AS page, t.total,
       CAST(floor((t.total + {K.PAGE_SIZE} - 1) / {K.PAGE_SIZE}) AS BIGINT) AS last_page
FROM (SELECT * FROM f ORDER BY published_at DESC NULLS LAST, id DESC LIMIT {K.PAGE_SIZE} OFFSET {2 * K.PAGE_SIZE}) f, t"""
SQL["article_page_deep"] = SQL["article_page"].replace("CAST(3 AS BIGINT) AS page", f"CAST({Q.DEEP_PAGE} AS BIGINT) AS page") \
    .replace(f"OFFSET {2 * K.PAGE_SIZE})", f"OFFSET {(Q.DEEP_PAGE - 1) * K.PAGE_SIZE})")
SQL["article_detail"] = f"""{AS_CTE},{_J}
SELECT id, title, source, category, published_at, url, is_duplicate, CAST(length(body) AS BIGINT) AS body_len,
       summary, sentiment,
       CASE WHEN summary IS NOT NULL AND coalesce(orig_len, 0) <> 0 THEN round(summary_len / orig_len * 100, 4)
            WHEN summary IS NOT NULL THEN 0.0 END AS compression_pct,
       body AS preview
FROM j WHERE id = {Q.ARTICLE_ID}"""
SQL["summary_targets"] = f"""{AS_CTE},{_J}
SELECT id, title, category, published_at FROM j
WHERE category = {lit(Q.CATEGORY)} AND NOT summarized AND NOT is_duplicate"""


_EXPORT = ", ".join(k for k, _ in K.EXPORT_COLUMNS)
SQL["export_view"] = f"{AS_CTE},{_J}\nSELECT {_EXPORT} FROM j WHERE summarized AND NOT is_duplicate"

# counts and metrics --------------------------------------------------------------
SQL["raw_counts"] = f"""WITH {RP_CTE}
SELECT count(*) AS total, count(*) FILTER (WHERE crawl_status = 'ok') AS ok FROM rp"""
SQL["category_counts"] = f"""{A_ONLY}
SELECT coalesce(category, {lit(K.DEFAULT_CATEGORY)}) AS category, count(*) AS n FROM a WHERE NOT is_duplicate GROUP BY 1"""
SQL["daily_counts"] = f"""{A_ONLY}
SELECT published_at AS day, count(*) AS n FROM a WHERE NOT is_duplicate AND published_at IS NOT NULL GROUP BY 1"""
SQL["source_counts"] = f"""{A_ONLY}
SELECT coalesce(source, {lit(K.DEFAULT_SOURCE)}) AS source, count(*) AS n FROM a WHERE NOT is_duplicate GROUP BY 1"""
SQL["recent_days"] = f"""{A_ONLY}
SELECT published_at AS day, count(*) AS n FROM a WHERE NOT is_duplicate AND published_at IS NOT NULL
GROUP BY 1 ORDER BY day DESC LIMIT 5"""
SQL["sentiment_overall"] = f"""{AS_CTE}
SELECT coalesce(sentiment, 'unknown') AS sentiment, count(*) AS n FROM s GROUP BY 1"""
SQL["sentiment_by_category"] = f"""{AS_CTE}
SELECT coalesce(a.category, {lit(K.DEFAULT_CATEGORY)}) AS category, coalesce(s.sentiment, 'unknown') AS sentiment,
       count(*) AS n
FROM s JOIN a ON a.id = s.article_id GROUP BY 1, 2"""
SQL["sentiment_pivot"] = f"""{AS_CTE},
bycat AS (SELECT coalesce(a.category, {lit(K.DEFAULT_CATEGORY)}) AS category, coalesce(s.sentiment, 'unknown') AS sentiment
       FROM s JOIN a ON a.id = s.article_id)
SELECT category,
  CAST(count(*) FILTER (WHERE sentiment = 'positive') AS BIGINT) AS positive,
  CAST(count(*) FILTER (WHERE sentiment = 'neutral') AS BIGINT) AS neutral,
  CAST(count(*) FILTER (WHERE sentiment = 'negative') AS BIGINT) AS negative,
  CAST(count(*) FILTER (WHERE sentiment NOT IN ('positive', 'neutral', 'negative')) AS BIGINT) AS unknown
FROM bycat GROUP BY category"""
SQL["quality_metrics"] = f"""WITH {A_CTE},{S_CTE},{RP_CTE[1:] if RP_CTE.startswith(chr(10)) else RP_CTE},
rc AS (SELECT count(*) AS raw_total, count(*) FILTER (WHERE crawl_status = 'ok') AS raw_ok FROM rp),
cc AS (SELECT count(*) AS clean_total, count(*) FILTER (WHERE is_duplicate) AS duplicates FROM a),
sc AS (SELECT count(*) AS summarized, avg(CAST(summary_len AS DOUBLE) / nullif(orig_len, 0)) AS comp FROM s)
SELECT raw_total, raw_ok,
       round(CASE WHEN raw_total > 0 THEN raw_ok / raw_total * 100 ELSE 0.0 END, 6) AS crawl_success_rate,
       clean_total, duplicates,
       CAST(CASE WHEN raw_total >= clean_total THEN raw_total - clean_total ELSE 0 END AS BIGINT) AS dedup_removed,
       summarized,
       round(CASE WHEN greatest(clean_total - duplicates, 0) > 0
                  THEN summarized / greatest(clean_total - duplicates, 0) * 100 ELSE 0.0 END, 6) AS summary_coverage,
       round(coalesce(comp * 100, 0.0), 6) AS avg_compression
FROM rc, cc, sc"""
SQL["article_count"] = f"""{A_ONLY}
SELECT count(*) AS n FROM a WHERE category = {lit(Q.CATEGORY)} AND NOT is_duplicate"""

# vectors ----------------------------------------------------------------------
_HEX = "'0123456789abcdef'"
_BUCKET = (f"((strpos({_HEX}, substr(md5(g), 31, 1)) - 1) * 16 + (strpos({_HEX}, substr(md5(g), 32, 1)) - 1))")
SQL["hash_vector"] = f"""{AS_CTE},{_J},
ct AS (
  SELECT id, {trim_ws("coalesce(title, '') || ' ' || CASE WHEN summary IS NOT NULL AND summary <> '' THEN summary "
                      "ELSE coalesce(body, '') END")} AS txt FROM j),
tk AS (SELECT id, unnest(regexp_extract_all(lower(txt), '[0-9A-Za-z가-힣]+')) AS t FROM ct),
gr AS (
  SELECT id, t AS g FROM tk
  UNION ALL
  SELECT id, unnest([substr(t, i, 2) FOR i IN range(1, length(t))]) AS g FROM tk WHERE length(t) > 1),
bk AS (SELECT id, {_BUCKET} AS idx, count(*) AS n FROM gr GROUP BY 1, 2),
nm AS (SELECT id, sqrt(sum(n * n)) AS nrm FROM bk GROUP BY id)
SELECT bk.id, CAST(bk.idx AS BIGINT) AS idx, round(bk.n / nm.nrm, 6) AS w FROM bk JOIN nm ON bk.id = nm.id"""

SQL["vector_norm"] = """
WITH ex AS (SELECT vec_id, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS pos FROM embeddings),
nm AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS n FROM ex GROUP BY vec_id)
SELECT ex.vec_id, CAST(ex.pos AS BIGINT) AS pos,
       round(CASE WHEN nm.n > 0 THEN CAST(ex.x AS DOUBLE) / nm.n ELSE CAST(ex.x AS DOUBLE) END, 6) AS x
FROM ex JOIN nm ON ex.vec_id = nm.vec_id"""

# ingest ---------------------------------------------------------------------------
_ITEMS = R_CTE + f""",
it AS (
  SELECT source, category, CAST(floor(id / 50) AS BIGINT) AS feed_no,
         CAST(row_number() OVER (PARTITION BY source, category, floor(id / 50) ORDER BY id) - 1 AS BIGINT) AS item_pos,
         url AS guid, url, coalesce(title, '') AS title,
         strftime({day_of("id")}, '%Y-%m-%d') || 'T01:00:00+00:00' AS published_at
  FROM r),
reg AS (
  SELECT source, category, 'https://' || source || '/rss/' || category || '.xml' AS feed_url,
         CAST(row_number() OVER (PARTITION BY source ORDER BY category) AS BIGINT) AS feed_pos
  FROM (SELECT DISTINCT source, category FROM r)),
prev AS (SELECT source, category, max(published_at) AS cur FROM it WHERE published_at < '{Q.PREV_RUN_BEFORE}'
         GROUP BY 1, 2),
fresh AS (
  SELECT it.* FROM it LEFT JOIN prev ON it.source = prev.source AND it.category = prev.category
  WHERE prev.cur IS NULL OR it.published_at > prev.cur),
bud AS (SELECT fresh.* FROM fresh JOIN reg ON fresh.source = reg.source AND fresh.category = reg.category),
lim AS (
  SELECT * FROM (
    SELECT fresh.*, CAST(row_number() OVER (PARTITION BY fresh.source
                         ORDER BY reg.feed_pos, fresh.feed_no, fresh.item_pos, fresh.guid) AS BIGINT) AS budget_rank
    FROM fresh JOIN reg ON fresh.source = reg.source AND fresh.category = reg.category)
  WHERE budget_rank <= {K.FETCH_LIMIT})"""
_IC = "source, category, feed_no, item_pos, guid, url, title, published_at"
SQL["feed_items"] = f"WITH {_ITEMS}\nSELECT {_IC} FROM it"
SQL["feed_select"] = f"WITH {_ITEMS}\nSELECT source, category, feed_url, feed_pos FROM reg WHERE category = {lit(Q.CATEGORY)}"
SQL["item_query"] = f"WITH {_ITEMS}\nSELECT {_IC} FROM it WHERE strpos(lower(title), {lit(Q.ITEM_QUERY)}) > 0"
SQL["filter_new"] = f"WITH {_ITEMS}\nSELECT {_IC} FROM fresh"
SQL["source_budget"] = f"WITH {_ITEMS}\nSELECT {_IC} FROM bud"
SQL["source_budget_limited"] = f"WITH {_ITEMS}\nSELECT {_IC}, budget_rank FROM lim"


#: Cursors after a run, from CTE ``touched`` (source, category, newest).
_CURSORS = """
SELECT t.source, t.category, CASE WHEN p.cur IS NULL THEN t.newest WHEN t.newest IS NULL THEN p.cur ELSE greatest(t.newest, p.cur) END AS last_pubdate
FROM touched t LEFT JOIN prev p ON t.source = p.source AND t.category = p.category
UNION ALL
SELECT p.source, p.category, p.cur FROM prev p
WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.source = p.source AND t.category = p.category)"""
_TOUCHED = "touched AS (SELECT source, category, max(published_at) AS newest FROM bud GROUP BY 1, 2)"
SQL["feed_cursor"] = f"WITH {_ITEMS},\n{_TOUCHED}{_CURSORS}"
SQL["feed_cursor_limited"] = f"""WITH {_ITEMS},
left_behind AS (SELECT f.source, f.category, min(f.published_at) AS floor FROM fresh f
  WHERE NOT EXISTS (SELECT 1 FROM lim WHERE lim.source = f.source AND lim.category = f.category AND lim.guid = f.guid) GROUP BY 1, 2),
touched AS (SELECT lim.source, lim.category, max(lim.published_at) FILTER (floor IS NULL OR lim.published_at < floor) AS newest
  FROM lim LEFT JOIN left_behind l ON l.source = lim.source AND l.category = lim.category GROUP BY 1, 2){_CURSORS}"""
_KEYS = f"""{_ITEMS},
keys AS (SELECT source, category, guid, max(published_at) AS t FROM (
  SELECT source, category, guid, published_at FROM it WHERE published_at < '{Q.PREV_RUN_BEFORE}'
  UNION ALL SELECT source, category, guid, published_at FROM bud) GROUP BY 1, 2, 3)"""
SQL["feed_seen"] = f"WITH {_KEYS}\nSELECT source, category, guid, t FROM keys"
SQL["feed_state"] = f"""WITH {_KEYS},
{_TOUCHED},
cu AS ({_CURSORS})
SELECT cu.source, cu.category, cu.last_pubdate, count(keys.guid) AS n_seen
FROM cu LEFT JOIN keys ON keys.source = cu.source AND keys.category = cu.category GROUP BY 1, 2, 3"""
SQL["crawl_outcome"] = f"""WITH {_ITEMS}
SELECT b.source, b.category, b.guid, b.url,
       'rss+crawl' AS method,
       CASE WHEN coalesce(px.body, '') <> '' THEN coalesce(nullif(b.title, ''), px.title) ELSE b.title END AS title,
       CASE WHEN coalesce(px.body, '') <> '' THEN px.body END AS body,
       CASE WHEN coalesce(px.body, '') <> '' THEN 'ok' ELSE 'failed' END AS crawl_status
FROM bud b LEFT JOIN px ON b.url = px.url"""
SQL["raw_guid_exists"] = f"""WITH {_ITEMS}
SELECT {_IC} FROM it WHERE EXISTS (SELECT 1 FROM r WHERE r.source = it.source AND r.guid = it.guid)"""
SQL["uncleaned"] = f"WITH {RP_CTE}\nSELECT id, url, title FROM rp WHERE id NOT IN (SELECT id * 4 FROM r)"

# streaming ------------------------------------------------------------------------
SQL["stream_daily"] = """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"""
SQL["stream_dedup"] = f"""WITH {_ITEMS},
landed AS (SELECT {_IC} FROM it UNION ALL SELECT {_IC} FROM it WHERE item_pos % 3 = 0)
SELECT {_IC} FROM (SELECT *, row_number() OVER (PARTITION BY source, guid) AS nth FROM landed) WHERE nth = 1"""

# analysis, digest, summaries, report, health -----------------------------------------
_SEL = f"""{AS_CTE},{_J},
sel AS (
  SELECT CAST(row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC) AS BIGINT) AS ordinal, * FROM (
    SELECT * FROM j WHERE category = {lit(Q.CATEGORY)} AND NOT is_duplicate))"""
SQL["analysis_selection"] = f"{_SEL}\nSELECT ordinal, id, title, category, source, published_at FROM sel"

_DIGEST = f""",
stok AS (SELECT t AS token FROM (SELECT unnest(regexp_extract_all(coalesce(title, ''), {lit(K.KEYWORD_PATTERN)})) AS t
         FROM sel) WHERE NOT list_contains({STOP}, t) AND length(t) >= 2),
kw AS (SELECT list(token ORDER BY n DESC, token) AS keywords FROM (
       SELECT token, count(*) AS n FROM stok GROUP BY token ORDER BY n DESC, token LIMIT 8)),
ct AS (SELECT list(category || ' ' || CAST(n AS VARCHAR) ORDER BY n DESC, category) AS top_categories FROM (
       SELECT coalesce(category, 'None') AS category, count(*) AS n FROM sel GROUP BY 1 ORDER BY n DESC, category LIMIT 3)),
sr AS (SELECT list(source || ' ' || CAST(n AS VARCHAR) ORDER BY n DESC, source) AS sources FROM (
       SELECT coalesce(source, 'None') AS source, count(*) AS n FROM sel GROUP BY 1)),
dg AS (SELECT (SELECT count(*) FROM sel) AS n_articles, coalesce(kw.keywords, []) AS keywords,
              coalesce(ct.top_categories, []) AS top_categories, coalesce(sr.sources, []) AS sources FROM kw, ct, sr)"""
SQL["insight_digest"] = f"{_SEL}{_DIGEST}\nSELECT * FROM dg"
SQL["selection_digest_text"] = f"""{_SEL}
SELECT ordinal, CAST(ordinal AS VARCHAR) || '. (' || coalesce(CAST(published_at AS VARCHAR), 'None') || ' / '
       || coalesce(source, 'None') || ' / ' || coalesce(category, 'None') || ') ' || coalesce(title, '')
       || chr(10) || '   ' || CASE WHEN coalesce(summary, '') <> '' THEN summary ELSE coalesce(body, '') END AS line
FROM sel"""

_TGT = f"""{AS_CTE},{_J},
tg AS (SELECT id, title, body FROM j WHERE NOT summarized AND NOT is_duplicate),
{summary_ctes("tg", "id", "body", "bs")},
built AS (
  SELECT tg.id AS article_id, bs_sum.summary, CAST(length(tg.body) AS BIGINT) AS orig_len,
         CAST(length(bs_sum.summary) AS BIGINT) AS summary_len,
         CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS sentiment, 'mock' AS model
  FROM (SELECT id, title, body, {_hint_count(K.POSITIVE_HINTS, "(title || body)")} AS p,
               {_hint_count(K.NEGATIVE_HINTS, "(title || body)")} AS n FROM tg) tg
  JOIN bs_sum ON tg.id = bs_sum.k
  WHERE length({trim_ws("bs_sum.summary")}) > 0)"""
SQL["summaries_built"] = f"{_TGT}\nSELECT * FROM built"
_ALL_BUILT = _TGT.replace("WHERE NOT summarized AND NOT is_duplicate", "WHERE NOT is_duplicate")
SQL["summary_outcomes"] = f"""{_TGT}
SELECT 'ok' AS outcome, (SELECT count(*) FROM built) AS n
UNION ALL SELECT 'failed', (SELECT count(*) FROM tg) - (SELECT count(*) FROM built)
UNION ALL SELECT 'done', (SELECT count(*) FROM j WHERE summarized AND NOT is_duplicate)"""
SQL["merge_summary"] = f"""{_ALL_BUILT}
SELECT article_id, summary, orig_len, summary_len, sentiment, model FROM s WHERE article_id NOT IN (SELECT article_id FROM built)
UNION ALL SELECT article_id, summary, orig_len, summary_len, sentiment, model FROM built"""

SQL["health_metrics"] = f"""WITH {A_CTE},{S_CTE},{RP_CTE},
dc AS (SELECT published_at AS day, count(*) AS n FROM a WHERE NOT is_duplicate AND published_at IS NOT NULL GROUP BY 1)
SELECT '{Q.AS_OF}' AS as_of,
  (SELECT count(*) FROM rp WHERE substr(collected_at, 1, 10) = '{Q.AS_OF}') AS collected_today,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM dc WHERE day = DATE '{Q.AS_OF}') AS published_today,
  (SELECT count(*) FROM rp WHERE crawl_status = 'failed') AS failed_crawl,
  (SELECT count(*) FROM rp WHERE id NOT IN (SELECT id * 4 FROM r)) AS uncleaned,
  (SELECT count(*) FROM a WHERE NOT is_duplicate AND id NOT IN (SELECT article_id FROM s)) AS unsummarized,
  (SELECT list(CAST(day AS VARCHAR) ORDER BY day) FROM (SELECT day FROM dc ORDER BY day DESC LIMIT 5)) AS recent_days"""
SQL["fetch_stats"] = f"""WITH {_ITEMS},
oc AS (SELECT b.source, CASE WHEN coalesce(px.body, '') <> '' THEN 'ok' ELSE 'failed' END AS st
       FROM bud b LEFT JOIN px ON b.url = px.url)
SELECT source, sum(f) AS feeds, 0 AS feed_failed, sum(k) AS saved, sum(bad) AS body_failed FROM (
  SELECT source, 1 AS f, 0 AS k, 0 AS bad FROM (SELECT DISTINCT source, category, feed_no FROM it)
  UNION ALL SELECT source, 0, 1, CASE WHEN st = 'failed' THEN 1 ELSE 0 END FROM oc) GROUP BY source
UNION ALL SELECT '*', (SELECT count(*) FROM (SELECT DISTINCT source, category, feed_no FROM it)), 0, count(*), count(*) FILTER (WHERE st = 'failed') FROM oc"""

# more oracles -------------------------------------------------------------------------
SQL["health_warnings"] = f"""
WITH hm AS ({SQL["health_metrics"]}),
qm AS ({SQL["quality_metrics"]})
SELECT rule FROM (
  SELECT 'last_run_failed' AS rule, (SELECT bad > 0 FROM (SELECT substr(collected_at, 1, 10) AS day, count(*) FILTER (crawl_status = 'failed') AS bad
    FROM ({f"WITH {RP_CTE} SELECT * FROM rp"}) GROUP BY 1 ORDER BY 1 DESC LIMIT 1)) AS hit
  UNION ALL SELECT 'nothing_collected_today', (SELECT collected_today FROM hm) = 0
  UNION ALL SELECT 'clean_backlog', (SELECT uncleaned FROM hm) > 0
  UNION ALL SELECT 'low_summary_coverage',
               (SELECT unsummarized FROM hm) > 0 AND (SELECT summary_coverage FROM qm) < {K.COVERAGE_WARN_PCT})
WHERE hit"""

SQL["stream_clean"] = SQL["merge_clean"].replace(", 'kept' AS outcome", "").replace(", 'inserted' FROM ins", " FROM ins")

SQL["stream_ingest"] = f"""WITH {_ITEMS},
ball AS (SELECT it.* FROM it JOIN reg ON it.source = reg.source AND it.category = reg.category)
SELECT b.source, 'rss+crawl' AS method, b.guid, b.url,
       CASE WHEN coalesce(px.body, '') <> '' THEN coalesce(nullif(b.title, ''), px.title) ELSE b.title END AS title,
       CASE WHEN coalesce(px.body, '') <> '' THEN px.body END AS body,
       b.category, b.published_at,
       CASE WHEN coalesce(px.body, '') <> '' THEN 'ok' ELSE 'failed' END AS crawl_status,
       '2024-01-15T09:00:00+09:00' AS collected_at, DATE '2024-01-15' AS collected_date
FROM ball b LEFT JOIN px ON b.url = px.url"""

SQL["insight_record"] = f"""{_SEL}{_DIGEST}
SELECT CAST(NULL AS VARCHAR) AS date_from, CAST(NULL AS VARCHAR) AS date_to, {lit(Q.CATEGORY)} AS category, n_articles,
  [{lit("[모의분석] '")} || coalesce(keywords[1], {lit(Q.CATEGORY)}) || {lit("' 관련 보도가 가장 많이 나타남")},
   {lit("[모의분석] 카테고리 분포: ")} || array_to_string(list_transform(top_categories, lambda x: x || '건'), ', ')]
    AS trends,
  CASE WHEN len(keywords) > 0 THEN keywords ELSE [{lit(Q.CATEGORY)}] END AS keywords,
  [{lit("[모의분석] 공통점: ")} || CAST(n_articles AS VARCHAR) || {lit("건 모두 같은 조건(기간·카테고리)으로 수집됨")},
   {lit("[모의분석] 차이점: 언론사별 비중 — ")} || array_to_string(list_transform(sources, lambda x: x || '건'), ', ')]
    AS common_diff,
  [{lit("[모의분석] 실제 시사점은 모델 분석을 켜면 생성됩니다.")}] AS implications,
  'mock' AS model
FROM dg"""


def _sec(name: str, sql: str, key: str, n: str, top: int | None, value: str = "CAST(NULL AS DOUBLE)") -> str:
    lim = f" LIMIT {top}" if top else ""
    return (f"SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {n} DESC, {key}) AS BIGINT) AS rank, "
            f"CAST({key} AS VARCHAR) AS key, CAST({n} AS BIGINT) AS n, CAST({value} AS DOUBLE) AS value "
            f"FROM (SELECT * FROM ({sql}) ORDER BY {n} DESC, {key}{lim})")


_METRIC_NAMES = ["raw_total", "raw_ok", "crawl_success_rate", "clean_total", "duplicates", "dedup_removed",
                 "summarized", "summary_coverage", "avg_compression"]
SQL["report_rows"] = "\nUNION ALL\n".join(
    [f"SELECT 'metrics' AS section, CAST({i + 1} AS BIGINT) AS rank, '{m}' AS key, CAST(NULL AS BIGINT) AS n, "
     f"CAST({m} AS DOUBLE) AS value FROM ({SQL['quality_metrics']})" for i, m in enumerate(_METRIC_NAMES)]
    + [_sec("category", SQL["category_counts"], "category", "n", K.TOP_N),
       _sec("keyword", SQL["top_keywords"], "token", "n", K.TOP_N),
       _sec("source", SQL["source_counts"], "source", "n", None),
       _sec("sentiment", SQL["sentiment_overall"], "sentiment", "n", None),
       _sec("trend_new", SQL["trend_new"], "token", "today_n", None),
       _sec("trend_rising", SQL["trend_rising"], "token", "today_n", None, "prior_avg")])

SQL["insight_latest"] = SQL["insight_record"].replace(
    f"WHERE category = {lit(Q.CATEGORY)} AND NOT is_duplicate", "WHERE NOT is_duplicate").replace(
    f"coalesce(keywords[1], {lit(Q.CATEGORY)})", f"coalesce(keywords[1], {lit(K.ALL_SCOPE)})").replace(
    f"ELSE [{lit(Q.CATEGORY)}] END AS keywords", f"ELSE [{lit(K.ALL_SCOPE)}] END AS keywords").replace(
    f"{lit(Q.CATEGORY)} AS category, n_articles", "CAST(NULL AS VARCHAR) AS category, n_articles").replace(
    "'mock' AS model\nFROM dg", "'mock' AS model, CAST(2 AS BIGINT) AS id\nFROM dg")

_HV = SQL["hash_vector"].split("SELECT bk.id, CAST(bk.idx AS BIGINT)")[0]
SQL["embed_missing"] = _HV + """,
hv AS (SELECT bk.id, bk.idx, bk.n / nm.nrm AS w FROM bk JOIN nm ON bk.id = nm.id),
org AS (SELECT id, CASE WHEN published_at < DATE '2024-01-08' AND published_at <> DATE '2024-01-01'
                        THEN 'cache' ELSE 'computed' END AS origin FROM a)
SELECT hv.id, org.origin, count(*) AS n_dims, round(sum(hv.w * hv.w), 6) AS sq_norm
FROM hv JOIN org ON hv.id = org.id GROUP BY 1, 2"""
SQL["merge_vectors"] = _HV + """,
hv AS (SELECT bk.id, bk.idx FROM bk),
md AS (SELECT id, CASE WHEN published_at < DATE '2024-01-08' AND published_at <> DATE '2024-01-01'
                        THEN 'mock-hash-256' ELSE 'computed' END AS model FROM a)
SELECT hv.id AS article_id, 'mock-hash-256' AS model, count(*) AS n_dims
FROM hv GROUP BY 1"""

SQL["boilerplate_hits"] = "SELECT doc_id, hits FROM (SELECT doc_id, CAST(" + " + ".join(
    f"CAST(regexp_matches(text, {lit(p)}) AS INTEGER)" for p in K.BOILERPLATE_PATTERNS) + \
    " AS BIGINT) AS hits FROM documents) WHERE hits > 0"

SQL["item_time"] = f"""WITH {R_CTE}
SELECT id, published_at,
  CASE WHEN regexp_matches(published_at, '^[A-Za-z]{{3}}, ')
       THEN strftime(strptime(regexp_replace(published_at, '^[A-Za-z]{{3}}, ', ''), '%d %b %Y %H:%M:%S %z')
                     AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00'
       WHEN regexp_matches(published_at, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T')
       THEN strftime(CAST(published_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00'
  END AS item_time
FROM r"""

SQL["event_components"] = f"""
WITH RECURSIVE keyed AS (
  SELECT doc_id AS id, 'title:' || sha1(k) AS key FROM (
    SELECT doc_id, lower(regexp_replace(split_part(text, chr(10), 1), {lit(K.TITLE_HASH_DROP)}, '', 'g')) AS k
    FROM documents) WHERE k <> ''
  UNION
  SELECT doc_id, 'text:' || sha1(text) FROM documents),
walk(id, label) AS (
  SELECT id, id FROM keyed
  UNION
  SELECT e2.id, w.label FROM walk w JOIN keyed e1 ON w.id = e1.id JOIN keyed e2 ON e1.key = e2.key),
lab AS (SELECT id, min(label) AS component FROM walk GROUP BY id),
sz AS (SELECT component, count(*) AS size FROM lab GROUP BY component)
SELECT lab.id, lab.component, sz.size FROM lab JOIN sz ON lab.component = sz.component WHERE sz.size >= 2"""

SQL["raw_sink"] = f"""WITH {_ITEMS},
pay AS (
  SELECT r.id, r.url, '{{"feed_url":' || to_json('https://' || source || '/rss/' || category || '.xml') || ',"title":' || to_json(coalesce(r.title, ''))
         || ',"link":' || to_json(r.url) || ',"published":' || to_json(CASE WHEN floor(r.id / 50) % 4 IN (1, 2)
              THEN strftime({day_of("r.id")}, '%Y-%m-%d') || 'T10:00:00+09:00'
              ELSE strftime({day_of("r.id")}, '%a, %d %b %Y') || ' 10:00:00 +0900' END) || '}}' AS raw_json
  FROM r)
SELECT b.source, 'rss+crawl' AS method, b.guid, b.url,
       CASE WHEN coalesce(px.body, '') <> '' THEN coalesce(nullif(b.title, ''), px.title) ELSE b.title END AS title,
       CASE WHEN coalesce(px.body, '') <> '' THEN px.body END AS body,
       b.category, b.published_at,
       CASE WHEN coalesce(px.body, '') <> '' THEN 'ok' ELSE 'failed' END AS crawl_status,
       pay.raw_json,
       '2024-01-15T09:00:00+09:00' AS collected_at, DATE '2024-01-15' AS collected_date
FROM bud b LEFT JOIN px ON b.url = px.url JOIN pay ON pay.url = b.url"""

SQL["clean_rejects"] = f"WITH {V_CTE}\nSELECT raw_id, reason, body_len FROM v WHERE reason <> 'ok'"
SQL["cluster_text"] = f"""{AS_CTE},{_J}
SELECT id, {trim_ws("coalesce(title, '') || ' ' || CASE WHEN summary IS NOT NULL AND summary <> '' THEN summary "
                    "ELSE coalesce(body, '') END")} AS text FROM j"""
SQL["json_arrays"] = f"""{A_ONLY}
SELECT id, CAST(to_json(toks) AS VARCHAR) AS keywords_json, toks AS keywords FROM (
  SELECT id, list_filter(regexp_extract_all(coalesce(title, ''), {lit(K.KEYWORD_PATTERN)}),
                         lambda t: NOT list_contains({STOP}, t) AND length(t) >= 2) AS toks FROM a)"""


# similar texts, cosine links, events -------------------------------------------------
_SIMILAR = f"""
sw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
ss AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
         THEN list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN ['short' || chr(1) || array_to_string(w, ' ')] ELSE [] END)) AS s FROM sw),
sn AS (SELECT doc_id, count(*) AS n FROM ss GROUP BY 1),
sp AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM ss x JOIN ss y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
sl2 AS (SELECT a, b FROM sp JOIN sn na ON na.doc_id = a JOIN sn nb ON nb.doc_id = b WHERE 9 * c >= 4 * (na.n + nb.n)),
both_ AS (SELECT a, b FROM sl2 UNION ALL SELECT b, a FROM sl2),
walk(id, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, walk.label FROM walk JOIN both_ e ON walk.id = e.a),
grp AS (SELECT id, min(label) AS component FROM walk GROUP BY id),
gsz AS (SELECT component, count(*) AS size FROM grp GROUP BY 1)"""
SQL["similar_groups"] = f"""WITH RECURSIVE {_SIMILAR.lstrip()}
SELECT grp.id AS doc_id, grp.component, gsz.size FROM grp JOIN gsz ON grp.component = gsz.component"""

_COSINE = f"""
cv AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
cn AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM cv
       WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cc AS (SELECT min(vec_id) AS c, e, max(n) AS n FROM cn WHERE n > 0 GROUP BY e),
cp AS (SELECT x.c AS a, y.c AS b, list_sum(list_transform(list_zip(x.e, y.e), lambda z: z[1] * z[2])) / (x.n * y.n) AS cosine
       FROM cc x JOIN cc y ON x.c < y.c AND len(x.e) = len(y.e)),
ck AS (SELECT * FROM cp WHERE cosine >= {Q.COSINE})"""
SQL["cosine_pairs"] = f"WITH {_COSINE}\nSELECT a, b, round(cosine, 6) AS cosine FROM ck"
SQL["cosine_classes"] = f"""WITH {_COSINE},
ends AS (SELECT c, count(*) AS n FROM (SELECT a AS c FROM ck UNION ALL SELECT b FROM ck) GROUP BY 1)
SELECT cn.vec_id, cc.c AS class_id, coalesce(ends.n, 0) AS n_links
FROM cn JOIN cc ON cn.e = cc.e LEFT JOIN ends ON ends.c = cc.c WHERE cn.n > 0"""

_MEMBERS = SQL["hash_vector"].split("SELECT bk.id, CAST(bk.idx AS BIGINT)")[0].replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
{_SIMILAR.lstrip()},
mb AS (SELECT j.id, grp.component AS cluster, j.title, j.source, j.sentiment, j.published_at, gsz.size AS k
       FROM grp JOIN gsz ON grp.component = gsz.component JOIN j ON j.id = grp.id WHERE gsz.size >= 2),
mx AS (SELECT mb.cluster, mb.id, bk.idx, bk.n / nm.nrm AS x, mb.k FROM mb JOIN bk ON bk.id = mb.id JOIN nm ON nm.id = mb.id),
mm AS (SELECT cluster, idx, sum(x) / max(k) AS m FROM mx GROUP BY 1, 2),
mu AS (SELECT cluster, idx, m / sqrt(sum(m * m) OVER (PARTITION BY cluster)) AS u FROM mm),
ms AS (SELECT mx.cluster, mx.id, round(sum(mx.x * mu.u), 9) AS sim FROM mx JOIN mu ON mu.cluster = mx.cluster AND mu.idx = mx.idx GROUP BY 1, 2),
mr AS (SELECT cluster, id AS rep_id FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY sim DESC, id) AS r FROM ms) WHERE r = 1)"""
_EVENTS = _MEMBERS + f""",
ev AS (SELECT cluster, count(*) AS size, count(DISTINCT source) AS n_sources, min(published_at) AS d0, max(published_at) AS d1
       FROM mb GROUP BY 1 HAVING count(DISTINCT source) >= {K.EVENT_MIN_SOURCES}),
evs AS (SELECT ev.cluster, ev.size, ev.n_sources, mr.rep_id, mb.title AS rep_title,
          CASE WHEN d0 IS NULL THEN '' WHEN d0 = d1 THEN d0::VARCHAR ELSE d0::VARCHAR || '~' || d1::VARCHAR END AS span
        FROM ev JOIN mr ON mr.cluster = ev.cluster JOIN mb ON mb.cluster = ev.cluster AND mb.id = mr.rep_id)"""
_LABELS = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in K.LABEL_DISPLAY.items())
_TONES = _MEMBERS + f""",
tl AS (SELECT cluster, source, CASE coalesce(sentiment, 'unknown') {_LABELS} ELSE {lit(K.DISPLAY_UNCLASSIFIED)} END AS label FROM mb),
tn AS (SELECT cluster, label, count(*) AS n FROM tl GROUP BY 1, 2),
tr AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS r, sum(n) OVER (PARTITION BY cluster) AS size,
         count(*) OVER (PARTITION BY cluster) AS n_labels FROM tn)"""
SQL["event_rep"] = f"{_MEMBERS}\nSELECT cluster, rep_id FROM mr"
SQL["events"] = f"{_EVENTS}\nSELECT * FROM evs"
SQL["event_top"] = f"{_EVENTS}\nSELECT * FROM evs ORDER BY size DESC, cluster LIMIT {K.EVENT_TOP_N}"
SQL["tone_by_source"] = f"{_TONES}\nSELECT cluster, source, label, count(*) AS n FROM tl GROUP BY 1, 2, 3"
SQL["tone_verdict"] = f"""{_TONES}
SELECT x.cluster, CASE WHEN x.n_labels > 1 AND x.n < x.size THEN 'split' ELSE 'agree' END AS verdict, x.label AS label1, x.n AS n1,
  CASE WHEN x.n_labels > 1 AND x.n < x.size THEN y.label END AS label2, CASE WHEN x.n_labels > 1 AND x.n < x.size THEN y.n END AS n2
FROM tr x LEFT JOIN tr y ON y.cluster = x.cluster AND y.r = 2 WHERE x.r = 1"""

SQL["report_full"] = SQL["report_rows"] + f"""
UNION ALL
SELECT 'event', rk, rep_title, size, n_sources::DOUBLE FROM (SELECT *, row_number() OVER (ORDER BY size DESC, cluster) AS rk FROM ({SQL["events"]})) WHERE rk <= {K.TOP_N}
UNION ALL
SELECT 'tone', e.rk, concat_ws(' ', t.verdict, t.label1, t.label2), t.n1, t.n2::DOUBLE
FROM (SELECT cluster, row_number() OVER (ORDER BY size DESC, cluster) AS rk FROM ({SQL["events"]})) e JOIN ({SQL["tone_verdict"]}) t ON t.cluster = e.cluster WHERE e.rk <= {K.TOP_N}
UNION ALL
SELECT 'insight', unnest(generate_series(1, len(x)))::BIGINT, unnest(x), NULL, NULL
FROM (SELECT list_concat(list_concat(trends, keywords), list_concat(common_diff, implications)) AS x FROM ({SQL["insight_record"]}))"""
