"""Line dedup: lines that are spread over many sites are boilerplate.

Method: per line hash, HyperLogLog sketches of the sites merge by
aggregation; lines whose estimate is near the threshold get an exact distinct
count; then one copy of each boilerplate line stays and the others go.

A line is the text between newlines without outer blanks; empty lines are
never boilerplate.  A line is boilerplate when it occurs on at least
``min_sites`` distinct sites (null sites are no site).  The copy at the first
place stays, so groups of whole copies keep their text once; places are ordered
by doc_id (rows without one come last), hash of the text, line number.
``keep_first=False`` removes every copy.

JVM-side throughout.  Lines that occur fewer than ``min_sites`` times cannot
be spread widely enough; a map-side combined count drops them, so that only
the occurrences of the remaining candidates are staged and sketched.  A line
held by a third of all documents is one key of combined aggregates, and a
join side that AQE may split.

Defined cases: a null text stays null and has no lines; rows that repeat a
doc_id with the same text count as one document and keep the same lines; rows
that repeat it with other text are told apart by the text's hash, and so are
rows without a doc_id; an empty
table gives an empty result; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import table

MIN_SITES = 10
LG_K = 12


def _lines(docs: DataFrame) -> DataFrame:
    at = docs.select(F.col("doc_id").alias("__d"), F.xxhash64("text").alias("__t"), F.col("source").alias("__s"),
                     F.posexplode(F.split("text", "\n", -1)).alias("__p", "__l"))
    line = F.trim("__l")
    return at.where(line != "").select("__d", "__t", "__s", "__p", F.xxhash64(line).alias("__h"), F.hash(line).alias("__g"))


def candidate_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Occurrences of the lines that occur at least ``min_sites`` times."""
    lines = _lines(docs)
    often = stage(lines.groupBy("__h", "__g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
                  .select("__h", "__g"), "lines-often")
    return lines.join(often, ["__h", "__g"])


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(__h, __g) of the lines on at least ``min_sites`` sites.

    The sketch decides alone outside [min_sites / 2, 2 min_sites], which is
    some thirty standard errors wide at lg_k = 12; inside it the exact count
    does."""
    est = stage(lines.groupBy("__h", "__g").agg(F.hll_sketch_estimate(F.hll_sketch_agg("__s", lg_k)).alias("est")), "lines-sites")
    far = est.where(F.col("est") > 2 * min_sites).select("__h", "__g")
    near = est.where((F.col("est") <= 2 * min_sites) & (F.col("est") * 2 >= min_sites)).select("__h", "__g")
    exact = lines.join(near, ["__h", "__g"]).groupBy("__h", "__g").agg(F.count_distinct("__s").alias("n")) \
        .where(F.col("n") >= min_sites).select("__h", "__g")
    return far.unionByName(exact)


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, keep_first: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with boilerplate lines removed from
    ``text``, plus ``__n_lines`` and ``__n_removed`` (long)."""
    lines = stage(candidate_lines(docs, min_sites), "lines")
    spread = stage(spread_lines(lines, min_sites, lg_k), "lines-spread")
    hits = lines.join(spread, ["__h", "__g"])
    if keep_first:
        place = F.struct(F.col("__d").isNull().alias("none"), F.col("__d").alias("d"), F.col("__t").alias("t"), F.col("__p").alias("p"))
        first = hits.groupBy("__h", "__g").agg(F.min(place).alias("__first"))
        hits = hits.join(first, ["__h", "__g"]).where(place != F.col("__first"))
    gone = hits.groupBy("__d", "__t").agg(F.sort_array(F.collect_set("__p")).alias("__gone"))
    # the lines are cut before the join, so that what follows only slices them
    keyed = docs.withColumn("__t", F.xxhash64("text")).withColumn("__parts", F.split("text", "\n", -1)).drop("text")
    out = keyed.join(gone.withColumnRenamed("__t", "__u"),
                     F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__t") == F.col("__u")), "left")
    starts = F.concat(F.array(F.lit(0)), F.transform("__gone", lambda x: x + 1))
    ends = F.concat(F.col("__gone"), F.array(F.size("__parts")))
    runs = F.zip_with(starts, ends, lambda a, b: F.slice("__parts", a + 1, b - a))           # between two lines that go
    kept = F.when(F.col("__gone").isNull(), F.col("__parts")).otherwise(F.flatten(runs))
    columns = [F.array_join(kept, "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return out.select(*columns, F.when(F.col("__parts").isNull(), 0).otherwise(F.size("__parts")).cast("long").alias("__n_lines"),
                      F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("__n_removed"))


def op1_line_dedup(spark, sf_dir):
    """doc_id, n_lines, n_removed, kept_md5 (of the remaining text) of every document."""
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.md5(F.col("text").cast("binary")).alias("kept_md5"))


SQL = f"""
WITH docs AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
ln AS (SELECT doc_id, source, unnest(parts) AS l, generate_subscripts(parts, 1) AS p FROM docs),
t AS (SELECT doc_id, source, p, l, trim(l, ' ') AS k FROM ln),
b AS (SELECT k, min(doc_id) AS d FROM t WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}),
f AS (SELECT b.k, b.d, min(t.p) AS p FROM b JOIN t ON t.k = b.k AND t.doc_id = b.d GROUP BY b.k, b.d),
m AS (SELECT t.doc_id, t.p, t.l, f.k IS NOT NULL AND NOT (f.d = t.doc_id AND f.p = t.p) AS gone FROM t LEFT JOIN f ON f.k = t.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  md5(coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_md5
FROM m GROUP BY doc_id
"""
