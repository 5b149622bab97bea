"""Scalar text functions (Column -> Column).

All of them are built-in Spark expressions (whole-stage codegen, no Python)
except :func:`normalize_text`, whose entity decoding and NFKC step has no
Spark built-in and runs as one Arrow-batched pandas UDF.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import constants as K

WS = K.WHITESPACE_CLASS
# Sentence boundary: one of . ! ? 。 followed by whitespace.
SENTENCE_END = "([.!?。])" + WS + "+"
# Separator used when splitting text in SQL; not whitespace, absent from text.
SEP = "\x01"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters of WS (what str.strip() removes), for the native trim.
WS_CHARS = "".join(chr(c) for c in [9, 10, 11, 12, 13, 32, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680,
                                    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def unicode_trim(c: Column | str) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace (native
    two-sided trim over a character set; no regex scan)."""
    return F.trim(col_(c), F.lit(WS_CHARS))


def first_line(c: Column | str) -> Column:
    return F.substring_index(col_(c), "\n", 1)


def blank_to_null(c: Column | str) -> Column:
    c = col_(c)
    return F.when(c == "", F.lit(None)).otherwise(c)


# --------------------------------------------------------------------------
# F4 title hash
# --------------------------------------------------------------------------
def title_key(title: Column | str) -> Column:
    """Title reduced to ASCII alnum + Hangul, lower-cased (the hash input)."""
    return F.lower(F.regexp_replace(F.coalesce(col_(title), F.lit("")), K.TITLE_HASH_DROP, ""))


def title_hash(title: Column | str) -> Column:
    return F.sha1(title_key(title).cast("binary"))


# --------------------------------------------------------------------------
# F6 keyword tokens
# --------------------------------------------------------------------------
def keyword_tokens(title: Column | str, stopwords=K.STOPWORDS) -> Column:
    """All keyword tokens of a title, in order, repeats kept, stop words out."""
    toks = F.regexp_extract_all(F.coalesce(col_(title), F.lit("")), F.lit(K.KEYWORD_PATTERN), 0)
    stop = list(stopwords)
    if not stop:
        return F.filter(toks, lambda t: F.length(t) >= 2)
    return F.filter(toks, lambda t: (~t.isin(stop)) & (F.length(t) >= 2))


# --------------------------------------------------------------------------
# F1 / F2 text normalisation
# --------------------------------------------------------------------------
_TAG_RE = re.compile(K.HTML_TAG)


def _decode_detag_nfkc_py(s: pd.Series) -> pd.Series:
    # entity decoding -> tags to a space -> NFKC, in this order (the order
    # matters: decoded '&lt;b&gt;' is a tag afterwards).
    def one(v):
        if v is None:
            return None
        if "&" in v:
            v = html.unescape(v)
        if "<" in v:
            v = _TAG_RE.sub(" ", v)
        return v if unicodedata.is_normalized("NFKC", v) else unicodedata.normalize("NFKC", v)

    return s.map(one)


# Deterministic: Catalyst evaluates each distinct call once per row.
_decode_detag_nfkc = F.pandas_udf(_decode_detag_nfkc_py, StringType())


def strip_boilerplate(c: Column | str, patterns=K.BOILERPLATE_PATTERNS) -> Column:
    """Each pattern in order -> one space."""
    c = col_(c)
    for p in patterns:
        c = F.regexp_replace(c, p, " ")
    return c


def might_hold_boilerplate(c: Column | str, requires=K.BOILERPLATE_REQUIRES) -> Column:
    """False only for texts that hold none of the literals every
    boilerplate match needs (then stripping is the identity)."""
    c = col_(c)
    out = F.lit(False)
    for lit in dict.fromkeys(requires):
        out = out | (F.instr(c, lit) > 0)
    return out


# Blank runs that change when collapsed to one space: any run holding a
# tab / NBSP / zero-width space, or two or more characters.  (A lone space
# is left alone instead of being rewritten by itself.)
_BLANK_RUN_TO_FIX = "[\t\u00a0\u200b][ \t\u00a0\u200b]*| [ \t\u00a0\u200b]+"


def collapse_blanks(c: Column | str) -> Column:
    """Blank runs -> one space, 3+ newlines -> 2, strip."""
    c = F.regexp_replace(col_(c), _BLANK_RUN_TO_FIX, " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    return unicode_trim(c)


def normalize_text(c: Column | str, strip_boilerplate_: bool = True) -> Column:
    """'' for NULL/empty; entities, tags, NFKC; boilerplate; blanks."""
    v = _decode_detag_nfkc(F.coalesce(col_(c), F.lit("")))
    if strip_boilerplate_:
        v = F.when(might_hold_boilerplate(v), strip_boilerplate(v)).otherwise(v)
    return collapse_blanks(v)


def boilerplate_hits(c: Column | str, patterns=K.BOILERPLATE_PATTERNS) -> Column:
    """F2 diagnostics: number of boilerplate patterns that match the text."""
    c = col_(c)
    total = F.lit(0)
    for p in patterns:
        total = total + c.rlike(p).cast("int")
    return total


# --------------------------------------------------------------------------
# F7 extractive summary
# --------------------------------------------------------------------------
def mark_sentences(body: Column | str) -> Column:
    """Stripped body with every sentence boundary (. ! ? 。 + whitespace run)
    replaced by the punctuation and one SEP character."""
    return F.regexp_replace(unicode_trim(col_(body)), SENTENCE_END, "$1" + SEP)


def sentences(body: Column | str) -> Column:
    """Sentences of the stripped body, split after . ! ? 。 + whitespace."""
    return F.split(mark_sentences(body), SEP)


def extractive_summary(body: Column | str, max_chars: int = K.SUMMARY_MAX_CHARS,
                       prefix: str = K.SUMMARY_PREFIX) -> Column:
    """whole leading sentences while they fit into ``max_chars``.

    The boundary marking runs over the whole body.  In the marked text every
    separator is one character, so sentences that fit (total length plus
    one per separator <= max_chars) all lie in its first max_chars + 2
    characters; a sentence cut by that window would overflow anyway.  The
    fold therefore runs over the window's pieces only -- the result is the
    same as folding over all sentences.  The fold stops at the first
    overflow; no sentence fits -> the first ``max_chars`` characters.
    """
    b = F.coalesce(col_(body), F.lit(""))
    sents = F.split(F.substring(mark_sentences(b), 1, max_chars + 2), SEP)
    init = F.struct(F.lit("").alias("t"), F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(False).alias("stop"))

    def step(acc, s):
        overflow = acc["stop"] | ((acc["n"] + F.length(s)) > max_chars)
        return F.when(overflow, F.struct(acc["t"].alias("t"), acc["n"].alias("n"), acc["k"].alias("k"),
                                         F.lit(True).alias("stop"))) \
            .otherwise(F.struct(F.concat(acc["t"], s, F.lit(" ")).alias("t"), (acc["n"] + F.length(s) + 1).alias("n"),
                                (acc["k"] + 1).alias("k"), F.lit(False).alias("stop")))

    def finish(acc):
        return F.when(acc["k"] > 0, unicode_trim(F.substring(acc["t"], 1, max_chars))) \
            .otherwise(unicode_trim(F.substring(b, 1, max_chars)))

    # one fold expression: nothing outside it references the split pieces
    return unicode_trim(F.concat(F.lit(prefix), F.aggregate(sents, init, step, finish)))


# --------------------------------------------------------------------------
# F11 / F12 composed texts
# --------------------------------------------------------------------------
def cluster_text(title: Column | str, summary: Column | str, body: Column | str,
                 body_chars: int | None = None) -> Column:
    """title + (summary, else the body, or its first ``body_chars``)."""
    s, whole = col_(summary), F.coalesce(col_(body), F.lit(""))
    tail = F.when(s.isNotNull() & (s != ""), s).otherwise(
        whole if body_chars is None else F.substring(whole, 1, body_chars))
    return unicode_trim(F.concat(F.coalesce(col_(title), F.lit("")), F.lit(" "), tail))


def cut_cell(c: Column | str, limit: int = K.EXPORT_CELL_LIMIT, suffix: str = K.EXPORT_CUT_SUFFIX) -> Column:
    """Strings longer than ``limit`` are cut and marked."""
    c = col_(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(suffix))).otherwise(c)
