"""Date functions on text.

F5 keeps the *written* calendar day and never converts zones, so the day is
read from the text: a ``Y-M-D`` / ``Y.M.D`` / ``Y/M/D`` run (this covers the
ISO forms and the dotted and slashed spellings), an RFC-822 date
(``Wed, 22 Jul 2026 18:13:49 +0900``) or a compact ``YYYYMMDD``.  An
impossible day falls through to the fallback text.  All built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, unicode_trim

# FIXED VALUES: English month abbreviations (RFC-822 / C locale), in order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

YMD_RUN = r"(\d{4})[-./](\d{1,2})[-./](\d{1,2})"
RFC822 = (r"^[A-Za-z]{3}, (\d{1,2}) ([A-Za-z]{3}) (\d{4}) \d{1,2}:\d{1,2}:\d{1,2} "
          r"(?:[+-]\d{2}:?\d{2}|Z|UTC|GMT)$")
COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:T\d{2}(?:\d{2}){0,2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:?\d{2})?)?$"


def _ymd(y: Column, m: Column, d: Column) -> Column:
    txt = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.try_to_date(txt, "yyyy-MM-dd")


def _month_number(name: Column) -> Column:
    m = F.lower(name)
    expr = F.lit(None).cast("string")
    for i, mon in reversed(list(enumerate(MONTHS, start=1))):
        expr = F.when(m == mon, F.lit(str(i))).otherwise(expr)
    return expr


def _day_of(text: Column) -> Column:
    run = F.when(text.rlike(YMD_RUN), _ymd(F.regexp_extract(text, YMD_RUN, 1),
                                           F.regexp_extract(text, YMD_RUN, 2),
                                           F.regexp_extract(text, YMD_RUN, 3)))
    rfc = F.when(text.rlike(RFC822), _ymd(F.regexp_extract(text, RFC822, 3),
                                          _month_number(F.regexp_extract(text, RFC822, 2)),
                                          F.regexp_extract(text, RFC822, 1)))
    compact = F.when(text.rlike(COMPACT), _ymd(F.regexp_extract(text, COMPACT, 1),
                                               F.regexp_extract(text, COMPACT, 2),
                                               F.regexp_extract(text, COMPACT, 3)))
    return F.coalesce(run, rfc, compact)


def normalize_date(value: Column | str, fallback: Column | str | None = None) -> Column:
    """DATE of the written day of ``value``, else of ``fallback``, else NULL."""
    days = [_day_of(unicode_trim(F.coalesce(col_(value).cast("string"), F.lit(""))))]
    if fallback is not None:
        days.append(_day_of(unicode_trim(F.coalesce(col_(fallback).cast("string"), F.lit("")))))
    return F.coalesce(*days)


def item_time(published: Column | str, updated: Column | str | None = None) -> Column:
    """Item time as a UTC timestamp; published else updated; NULL if unreadable.

    RFC-822 text is parsed after the weekday is removed (Spark refuses to
    parse ``EEE``); ISO text is parsed as is.
    """
    def one(c: Column) -> Column:
        t = unicode_trim(c)
        no_wd = F.regexp_replace(t, r"^[A-Za-z]{3},\s*", "")
        rfc = F.coalesce(F.try_to_timestamp(no_wd, F.lit("d MMM yyyy HH:mm:ss Z")),
                         F.try_to_timestamp(no_wd, F.lit("d MMM yyyy HH:mm:ss z")))
        iso = F.try_to_timestamp(F.regexp_replace(t, "Z$", "+00:00"))
        return F.when(t.rlike(r"^[A-Za-z]{3},"), rfc).otherwise(iso)

    out = one(col_(published))
    if updated is not None:
        out = F.coalesce(out, one(col_(updated)))
    return out


def iso_utc(ts: Column | str) -> Column:
    """Timestamp -> 'YYYY-MM-DDTHH:MM:SS+00:00' text in UTC (second
    precision), whatever the session time zone."""
    utc_wall = F.to_utc_timestamp(col_(ts), F.current_timezone())
    return F.concat(F.date_format(utc_wall, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def date_span(first: Column | str, last: Column | str) -> Column:
    """F16: '' without dates, the day when first == last, else 'first~last'."""
    a, b = col_(first).cast("string"), col_(last).cast("string")
    return F.when(a.isNull(), F.lit("")).when(a == b, a).otherwise(F.concat(a, F.lit("~"), b))


def day_prefix(c: Column | str) -> Column:
    """the first 10 characters of a timestamp text."""
    return F.substring(col_(c), 1, 10)
