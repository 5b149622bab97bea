"""Fixed values and default parameters.

Everything under "FIXED VALUES" must stay equal to the behaviour this
library reproduces (word lists, label tables, patterns, literals); it is
stated here once, in its natural order, and imported everywhere else.
Lexicons are *parameters* of the operators: callers may pass their own.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Keyword tokens: runs of >= 2 Hangul syllables or >= 3 ASCII letters.
KEYWORD_PATTERN = r"[가-힣]{2,}|[A-Za-z]{3,}"

# Stop words removed from title keywords.
STOPWORDS = (
    "기자", "뉴스", "연합뉴스", "한국경제", "지난", "올해", "관련", "대한", "이번", "가장",
    "위해", "통해", "대해", "따라", "밝혔다", "말했다", "라며", "하는", "있다", "했다",
    "시각", "헤드라인", "종합", "속보",
)

# Sentiment labels, their aliases and display names.
LABELS = ("positive", "negative", "neutral")
LABEL_ALIASES = {
    "긍정": "positive",
    "긍정적": "positive",
    "pos": "positive",
    "부정": "negative",
    "부정적": "negative",
    "neg": "negative",
    "중립": "neutral",
    "중립적": "neutral",
    "neu": "neutral",
    "mixed": "neutral",
}
LABEL_DISPLAY = {
    "positive": "긍정",
    "negative": "부정",
    "neutral": "중립",
    "unknown": "미분류",
}
DISPLAY_UNCLASSIFIED = "미분류"

# Lexicon sentiment hints (offline labeller).
POSITIVE_HINTS = ("성장", "호조", "상승", "흑자", "확대", "수출", "채용", "개선", "신기록", "돌파")
NEGATIVE_HINTS = ("하락", "적자", "감소", "우려", "논란", "사고", "위기", "부진", "해킹", "파산")

# URL query parameters that only track the reader.
TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")

# Body boilerplate, removed in this order (each match -> one space).
# Written for both Java regex (Spark) and RE2 (the SQL oracle): explicit
# classes instead of \w and \s, [^\n] instead of '.'.
_W = r"[\pL\pN_]"
_S = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BOILERPLATE_PATTERNS = (
    rf"^{_S}*[\pL\pN_가-힣]{{2,4}}{_S}*기자{_S}*(구독{_S}*구독중)?{_S}*(이전{_S}*다음)?{_S}*(이미지{_S}*확대)?{_S}*",
    rf"\({_S}*[가-힣]+=연합뉴스{_S}*\){_S}*[\pL\pN_가-힣]{{2,4}}{_S}*기자{_S}*={_S}*",
    rf"제보는{_S}*카카오톡[^\n]*$",
    rf"<{_S}*저작권자[^\n]*?>{_S}*",
    rf"ⓒ{_S}*[^{_S[1:-1]}]+{_S}*(무단전재|및)?[^\n]*?(금지|배포금지)\.?",
    r"\[[^\]]{0,20}(제공|연합뉴스|한경DB|사진)[^\]]{0,20}\]",
    rf"(이메일|메일){_S}*:?{_S}*[\pL\pN_.\-]+@[\pL\pN_.\-]+",
    r"[\pL\pN_.\-]+@[\pL\pN_.\-]+\.[a-zA-Z]{2,}",
)
# A literal every match of the pattern above (same position) contains; a
# text without it is left as is without running the pattern.
BOILERPLATE_REQUIRES = ("기자", "연합뉴스", "카카오톡", "저작권자", "ⓒ", "[", "@", "@")
WHITESPACE_CLASS = _S            # what str.strip() removes
BLANK_RUN = "[ \t\u00a0\u200b]+"  # space, tab, NBSP, zero-width space
HTML_TAG = r"<[^>]+>"
TITLE_HASH_DROP = r"[^0-9A-Za-z가-힣]+"

# Missing values in the clean layer.
DEFAULT_CATEGORY = "미분류"
DEFAULT_SOURCE = "미상"
ALL_SCOPE = "전체"

# Offline summary tag.
SUMMARY_PREFIX = "[모의요약] "

# Page extraction defaults (CSS-like selectors).
DEFAULT_TITLE_SELECTORS = ("meta[property='og:title']", "h1")
DEFAULT_BODY_SELECTORS = ("article", "#article", ".article-body")
DEFAULT_REMOVE_SELECTORS = ("script", "style", "figure", "aside", "nav")

# Export columns (key, header) in file order; long cells are cut.
EXPORT_COLUMNS = (
    ("id", "ID"),
    ("source", "언론사"),
    ("category", "카테고리"),
    ("published_at", "발행일"),
    ("title", "제목"),
    ("url", "URL"),
    ("summary", "요약"),
    ("sentiment", "감성"),
    ("orig_len", "원문길이"),
    ("summary_len", "요약길이"),
    ("is_duplicate", "유사중복"),
    ("body", "본문"),
)
EXPORT_CELL_LIMIT = 32000
EXPORT_CUT_SUFFIX = "…(생략)"

# ---------------------------------------------------------------------------
# DEFAULT PARAMETERS
# ---------------------------------------------------------------------------
MIN_BODY = 100
SUMMARY_MAX_CHARS = 200
SUMMARY_INPUT_CHARS = 4000
TOP_N = 5
TREND_DAYS = 7
PAGE_SIZE = 10
ANALYSIS_LIMIT = 60
ANALYSIS_BODY_CHARS = 400
CLUSTER_TEXT_BODY_CHARS = 300
EVENT_MIN_SOURCES = 2
EVENT_TOP_N = 10
VECTOR_DIM = 256
SEEN_GUID_CAP = 500
FETCH_LIMIT = 20
DETAIL_PREVIEW_CHARS = 600
COVERAGE_WARN_PCT = 90.0
