"""F3 URL normalisation as built-in Spark expressions.

Rule: trim; drop tab/CR/LF; split into scheme, netloc, path, query,
fragment; lower-case scheme and netloc; path without trailing '/' (empty
-> '/'); query pairs decoded, blank-valued pairs and tracking names dropped,
the rest re-encoded form-style in their original order; fragment dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import col_, unicode_trim

# RFC 3986 appendix B split.
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def form_encode(c: Column) -> Column:
    """Form-style percent encoding with the unreserved set A-Z a-z 0-9 - _ . ~
    (space -> '+'); Java's encoder keeps '*' and escapes '~', so swap those."""
    enc = F.url_encode(c)
    return F.replace(F.replace(enc, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def form_decode(c: Column) -> Column:
    """Form-style decoding ('+' -> space, %XX); undecodable input kept."""
    return F.coalesce(F.try_url_decode(c), c)


def url_parts(url: Column | str) -> dict[str, Column]:
    u = F.regexp_replace(unicode_trim(F.coalesce(col_(url), F.lit(""))), "[\t\r\n]", "")
    return {
        "scheme": F.lower(F.regexp_extract(u, _SPLIT, 1)),
        "netloc": F.regexp_extract(u, _SPLIT, 2),
        "has_netloc": u.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"),
        "path": F.regexp_extract(u, _SPLIT, 3),
        "query": F.regexp_extract(u, _SPLIT, 4),
    }


def clean_query(query: Column, drop=K.TRACKING_PARAMS) -> Column:
    pairs = F.split(query, "&")
    # keep 'k=v' pairs whose raw value is non-empty (blank values are dropped)
    kept = F.filter(pairs, lambda p: (F.instr(p, "=") > 0) & (F.instr(p, "=") < F.length(p)))
    decoded = F.transform(kept, lambda p: F.struct(
        form_decode(F.substring_index(p, "=", 1)).alias("k"),
        form_decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))
    kept2 = F.filter(decoded, lambda kv: ~kv["k"].isin(list(drop)))
    encoded = F.transform(kept2, lambda kv: F.concat(form_encode(kv["k"]), F.lit("="), form_encode(kv["v"])))
    return F.array_join(encoded, "&")


def normalize_url(url: Column | str, drop=K.TRACKING_PARAMS) -> Column:
    p = url_parts(url)
    path = F.regexp_replace(p["path"], "/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    q = clean_query(p["query"], drop)
    scheme = F.when(p["scheme"] != "", F.concat(p["scheme"], F.lit(":"))).otherwise(F.lit(""))
    netloc = F.when(p["has_netloc"] | (p["netloc"] != ""), F.concat(F.lit("//"), F.lower(p["netloc"]))) \
        .otherwise(F.lit(""))
    query = F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))
    return F.concat(scheme, netloc, path, query)


def url_host(url: Column | str) -> Column:
    """Lower-cased host (netloc without user info and port)."""
    net = url_parts(url)["netloc"]
    return F.lower(F.regexp_extract(net, r"^(?:[^@]*@)?([^:]*)", 1))


def url_first_segment(url: Column | str) -> Column:
    path = url_parts(url)["path"]
    return F.regexp_extract(path, r"^/([^/]*)", 1)
