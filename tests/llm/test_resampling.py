"""Importance resampling against a plain version of the contract."""

import hashlib
import math
import re
import zlib
from collections import Counter

from articleflow.llm import resampling

from .conftest import make, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    grams = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out, able = [], []
    for k, (doc_id, text) in enumerate(docs):
        words, f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in f)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None])
        if len(words) >= 20:
            able.append(k)
    able.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    for rank, k in enumerate(able[:5 * len(able) // 100]):
        out[k][4] = rank + 1
    return Counter(map(tuple, out))


def table_of(rnd):
    rows = [(i, prose(rnd, rnd.randint(0, 60), 300)) for i in range(400)]
    rows += [(500, None), (501, ""), (502, " .,! "), (503, "ÀÉ Straße naïve x9 " * 7), (504, prose(rnd, 20000, 10 ** 6)), (None, prose(rnd, 30))]
    return rows + [(7, rows[7][1])] * 150 + [(2 ** 60 + 1, prose(rnd, 25)), (-5, prose(rnd, 25))]


def test_resampling(spark):
    import random
    rnd = random.Random(8)
    rows = table_of(rnd)
    target = [rows[i][1] for i in range(0, 40, 2)] + [None, ""]
    docs = make(spark, [(d, t, "s") for d, t in rows]).withColumnRenamed("size", "rank").withColumnRenamed("lang", "score").repartition(5)
    marks = spark.createDataFrame([(t,) for t in target], "text string")
    want = brute(rows, target)
    assert max(r[4] or 0 for r in want) >= 20
    for how in ({}, {"run_rows": 30, "samples": 1 << 10, "segment": 20}, {"run_rows": 10, "samples": 40, "segment": 1}):
        got = resampling.resample(docs, marks, **how)
        assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
        assert Counter(tuple(r) for r in got.collect()) == want
    none = spark.createDataFrame([], "text string")
    assert Counter(tuple(r) for r in resampling.resample(docs, none).collect()) == brute(rows, [])
    assert resampling.resample(docs.limit(0), marks).count() == 0


def test_splitters_cut_evenly(spark):
    rows = spark.range(0, 20000, 1, 7).selectExpr("id AS doc_id", "false AS none", "0L AS n_features", "0L AS weight", "pmod(xxhash64(id), 50) AS score",
                                                  "true AS ok", "spark_partition_id() * 16777216L AS run")
    rows = rows.selectExpr("*", "row_number() OVER (PARTITION BY run ORDER BY score DESC, doc_id) - 1L AS at")
    for samples in (100, 20000):
        cuts = resampling.regular_splitters(rows, 20000, samples, 1000)
        sizes = [r["count"] for r in resampling._segments(rows, cuts).groupBy("segment").count().collect()]
        assert sum(sizes) == 20000 and 10 <= len(sizes) <= 40 and max(sizes) <= 3000
