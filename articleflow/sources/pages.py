"""S6 page extraction: HTML -> (title, body).

Selection follows the configured selector lists: removed elements are deleted
first, then the first selector in order whose first element has text wins
(``meta`` yields its ``content`` attribute).  Element text is the text nodes,
entity-decoded and stripped, joined by one space.

Pages are read by a stack of open elements (markup.py), so nested elements of
one name end where they should.  One Arrow-batched step reads a page once for
title and body.  Selectors may differ by source: a table of them is joined in,
sources without a row take the defaults.

Defined cases: a null page has neither title nor body; a text that no selector
finds is NULL.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import constants as K
from ..session import small_batches
from .markup import extract, wanted

_TEXTS = StructType([StructField("title", StringType()), StructField("body", StringType())])


def _tuple(selectors, default) -> tuple:
    return tuple(default) if selectors is None else tuple(selectors)


def _fixed(title_selectors, body_selectors, remove_selectors):
    """The step for one set of selectors; unsupported ones fail here."""
    lists = (tuple(title_selectors), tuple(body_selectors))
    remove = tuple(remove_selectors)
    wanted(remove, lists)

    @F.pandas_udf(_TEXTS)
    def texts(html: pd.Series) -> pd.DataFrame:
        want = wanted(remove, lists)
        return pd.DataFrame([extract(h, want) if h else (None, None) for h in html], columns=["title", "body"], dtype=object)
    return texts


@F.pandas_udf(_TEXTS)
def _by_row(html: pd.Series, title: pd.Series, body: pd.Series, remove: pd.Series) -> pd.DataFrame:
    """Page texts with selectors in the row (NULL lists: defaults)."""
    rows = []
    for h, t, b, r in zip(html, title, body, remove):
        want = wanted(_tuple(r, K.DEFAULT_REMOVE_SELECTORS), (_tuple(t, K.DEFAULT_TITLE_SELECTORS), _tuple(b, K.DEFAULT_BODY_SELECTORS)))
        rows.append(extract(h, want) if h else (None, None))
    return pd.DataFrame(rows, columns=["title", "body"], dtype=object)


def with_extracted(df: DataFrame, html_col: str = "html", title_col: str = "title", body_col: str = "body",
                   title_selectors=K.DEFAULT_TITLE_SELECTORS,
                   body_selectors=K.DEFAULT_BODY_SELECTORS,
                   remove_selectors=K.DEFAULT_REMOVE_SELECTORS,
                   by_source: DataFrame | None = None, source: Column | None = None) -> DataFrame:
    """S6 on a frame: adds ``title_col`` / ``body_col`` (NULL when nothing
    is found) and ``<body_col>_found``.

    ``by_source`` (source, title_selectors, body_selectors, remove_selectors;
    arrays, NULL = default; one row a source) with ``source`` (each page's
    source) replaces the selectors page by page."""
    df = small_batches(df)
    keep = [c for c in df.columns if c not in (html_col, title_col, body_col)]
    if by_source is None:
        step = _fixed(title_selectors, body_selectors, remove_selectors)(F.col(html_col))
        read = df.select(*keep, step.alias("__x"))
    else:
        names = ["title_selectors", "body_selectors", "remove_selectors"]
        rules = by_source.select(F.col("source").alias("__s"), *[F.col(c).alias(f"__{c}") for c in names])
        both = df.withColumn("__source", source).join(rules, F.col("__source") == F.col("__s"), "left")
        read = both.select(*keep, _by_row(F.col(html_col), *[F.col(f"__{c}") for c in names]).alias("__x"))
    return read.select(*keep, F.col("__x.title").alias(title_col), F.col("__x.body").alias(body_col),
                       F.col("__x.body").isNotNull().alias(body_col + "_found"))


def page_extract(pages: DataFrame, **how) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(page_id, url, title, body)``."""
    return with_extracted(pages.select("page_id", "url", "html"), **how).select("page_id", "url", "title", "body")
