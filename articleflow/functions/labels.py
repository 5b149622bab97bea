"""Sentiment functions (F8, F9, F10) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import col_, unicode_trim


def lexicon_sentiment(text: Column | str, positive=K.POSITIVE_HINTS, negative=K.NEGATIVE_HINTS) -> Column:
    """F8: number of distinct hint words present, positive vs negative."""
    t = F.coalesce(col_(text), F.lit(""))
    pos = F.lit(0)
    for h in positive:
        pos = pos + (F.instr(t, h) > 0).cast("int")
    neg = F.lit(0)
    for h in negative:
        neg = neg + (F.instr(t, h) > 0).cast("int")
    return F.when(pos > neg, F.lit("positive")).when(neg > pos, F.lit("negative")).otherwise(F.lit("neutral"))


def _map_lit(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def normalize_label(value: Column | str) -> Column:
    """canonical label, alias, else neutral (NULL/empty -> neutral)."""
    v = col_(value)
    t = F.lower(unicode_trim(v))
    return F.when(v.isNull() | (v == ""), F.lit("neutral")) \
        .when(t.isin(list(K.LABELS)), t) \
        .otherwise(F.coalesce(F.try_element_at(_map_lit(K.LABEL_ALIASES), t), F.lit("neutral")))


def display_label(label: Column | str) -> Column:
    """display name; NULL -> 'unknown' -> its display; others unclassified."""
    key = F.coalesce(col_(label), F.lit("unknown"))
    return F.coalesce(F.try_element_at(_map_lit(K.LABEL_DISPLAY), key), F.lit(K.DISPLAY_UNCLASSIFIED))
