"""Search, decontamination, toxicity, the pipeline and the registration."""

import os
import random
import re
import shutil
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from articleflow.llm import cover_tree, decontaminate, mix, queries, simhash, toxicity
from pyspark.sql import functions as F

from .conftest import make, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def brute_top_k(rows, every, k):
    ok = [(i, [int(np.floor(float(x) * 1024)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for q in {i for i, _ in ok if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for j, qv in ok if j == q for i, v in ok if i != q and len(v) == len(qv))[:k]
        out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return out


def test_top_k(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(6, 8))
    vecs = [(i, (centers[i % 6] * (1 + i % 3) + 0.1 * rnd.normal(size=8)).round(3).tolist()) for i in range(900)]
    vecs += [(1000 + i, [0.5] * 8) for i in range(300)]                             # ties
    vecs += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7),
             (None, [0.1] * 8), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (2200, []), (3, vecs[3][1]),
             (4, vecs[4][1]), (4, vecs[4][1]), (4, vecs[10][1]), (50, vecs[50][1]), (75, vecs[80][1]), (1025, [0.5] * 8)]    # repeated rows
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in vecs], "vec_id long, embedding array<double>, rank int, score int")
    monkeypatch.setattr(cover_tree, "SHARD", 200)
    monkeypatch.setattr(cover_tree, "BLOCK", 8)
    got = cover_tree.top_k(df, every=25)
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint"]
    assert Counter(tuple(r) for r in got.collect()) == brute_top_k(vecs, 25, 10)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", vecs)
    sql = queries.TOP_K_SQL.replace("% 100 = 0", "% 25 = 0").replace("(x::DOUBLE", "(x")
    assert Counter((r[0], r[1], r[2], r[3]) for r in con.execute(sql).fetchall()) == brute_top_k(vecs, 25, 10)
    blocks = cover_tree._packed(cover_tree._integers(df, 1024), {8: np.zeros((1, 8))}, 200)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(dim#\d+, cell#\d+, part#\d+", plan)
    assert cover_tree.top_k(df.limit(0)).count() == 0


def test_cover_tree_covers_and_prunes():
    rnd = np.random.default_rng(6)
    x = (rnd.normal(size=(40, 5))[rnd.integers(0, 40, 3000)] * 100 + rnd.normal(size=(3000, 5))).round()
    order, root = cover_tree.build(x, leaf=16)
    assert sorted(order.tolist()) == list(range(3000))
    nodes, visited = [root], 0
    while nodes:
        n = nodes.pop()
        assert np.sqrt(((x[order[n.lo:n.hi]] - n.center) ** 2).sum(1)).max() <= n.radius + 1e-6
        assert not n.children or (n.children[0].lo, n.children[-1].hi) == (n.lo, n.hi)
        nodes += n.children
        visited += not n.children
    search = cover_tree.Search(np.arange(1), x[:1].astype(np.int64), 5, float("-inf"))
    leaves = []
    search._leaf, keep = lambda *a: (leaves.append(1), keep(*a)), search._leaf
    search.visit(search.root, root, np.arange(3000)[order], x[order].astype(np.int64))
    assert len(leaves) < visited / 2
    big = np.full((2, 3), 2 ** 40)
    assert cover_tree.products(big, big).max() == 2 ** 63 - 1


def test_noise_is_compared_in_few_leaves():
    """Balls do not split vectors of noise: a tree that splits off a few points
    a level costs the square of the points."""
    x = np.random.default_rng(8).normal(size=(4000, 64))
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    order, root = cover_tree.build(x.astype(float))
    nodes, leaves = [root], 0
    while nodes:
        n = nodes.pop()
        nodes += n.children
        leaves += not n.children
    assert leaves < 200
    for big in (1, 2 ** 10, 2 ** 20):                                               # float32, float64, integers
        points, k = x * big, 10
        search = cover_tree.Search(np.arange(30), cover_tree.as_floats(points[:30]), k, float("-inf"))
        for lo in (0, 2500):                                                        # two shards, one after the other
            own = order[(order >= lo) & (order < (2500 if lo == 0 else 4000))]
            at, top = cover_tree.build(points[own].astype(float))
            search.visit(search.root, top, own[at], cover_tree.as_floats(points[own[at]]))
        found = dict(zip(range(30), [[] for _ in range(30)]))
        for q, v, s in zip(*(c.tolist() for c in search.best())):
            found[q].append((-s, v))
        for q in range(30):
            scores = points.astype(object) @ points[q].astype(object)
            assert found[q] == sorted((-s, v) for v, s in enumerate(scores.tolist()) if v != q)[:k]


def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (1 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_alignment():
    rnd = random.Random(2)
    for _ in range(60):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randint(1, 25))] for _ in range(2))
        assert decontaminate.align(np.array(a), np.array(b)) == smith_waterman(a, b)


def test_decontamination(spark, corpus):
    rnd = random.Random(7)
    items = [(i, prose(rnd, rnd.randint(14, 50), 5000)) for i in range(12)] + [(3, "other text of item three here"), (50, "too short"), (51, None)]
    common = prose(rnd, 25)
    items.append((60, common))

    def edited(text):
        w = text.split(" ")
        for k in range(3, len(w), 8):
            w[k] = "changed"
        return " ".join(w).upper()
    rows = corpus + [(500 + i, f"{prose(rnd, 40)} {items[i][1]}\n{prose(rnd, 40)}", "s") for i in range(6)]
    rows += [(520 + i, f"{prose(rnd, 40)} {edited(items[i][1])}, {prose(rnd, 40)}", "s") for i in range(6)]
    rows += [(600 + i, f"{prose(rnd, 5)} {common}", "s") for i in range(80)]
    rows += [(530, " ".join(items[0][1].split(" ")[:5]) + " " + prose(rnd, 30), "s")]
    table = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(make(spark, rows), table).collect()}
    want = {}
    for d, t, _ in rows:
        w = decontaminate.words_of(t)
        for i, item in items:
            v = decontaminate.words_of(item)
            if len(w) < 2000 and len(v) >= 3 and (s := smith_waterman(v, w) / len(v)) >= 0.5:
                want[d, i] = max(s, want.get((d, i), 0))
    assert got == want and {(500 + i, i) for i in range(6)} | {(520 + i, i) for i in range(6)} <= set(got)
    kept = decontaminate.decontaminate(make(spark, rows), table)
    assert kept.count() == len([r for r in rows if r[0] not in {d for d, _ in want}])
    assert decontaminate.leaks(make(spark, []), table).count() == 0
    assert decontaminate.leaks(make(spark, rows), table.limit(0)).count() == 0


def test_decontamination_of_edited_copies(spark):
    """One changed copy of each item: substituted, left out and inserted words."""
    rnd = random.Random(17)
    items = [(i, prose(rnd, rnd.randint(8, 50), 3000)) for i in range(40)] + [(40, "a b c d a b c d a b")]

    def edited(words, share, how):
        out = list(words)
        for k in sorted(rnd.sample(range(len(words)), int(share * len(words))), reverse=True):
            out[k:k + 1] = {"substitute": ["zz"], "leave": [], "insert": ["zz", words[k]]}[how]
        return out
    rows = []
    for share, how in [(0.1, "substitute"), (0.15, "substitute"), (0.2, "substitute"), (0.25, "substitute"), (0.25, "leave"), (0.5, "insert")]:
        rows += [(len(rows) + i, f"{prose(rnd, 40)} {' '.join(edited(t.split(' '), share, how))} {prose(rnd, 40)}", "s") for i, t in items]
    rows += [(1000, items[0][1], "s"), (1001, " zz ".join(items[1][1].split(" ")), "s")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(make(spark, rows), table).collect()}
    want = {}
    for d, t, _ in rows:
        ids = {w: k for k, w in enumerate(dict.fromkeys(decontaminate.words_of(t)))}
        text = np.array([ids[w] for w in decontaminate.words_of(t)])
        for i, item in items:
            v = decontaminate.words_of(item)
            if (s := decontaminate.align(np.array([ids.get(w, -1) for w in v]), text) / len(v)) >= 0.5:
                want[d, i] = s
    assert got == want and len(want) > 240


def test_toxicity_held_out(spark, corpus):
    rnd = random.Random(11)
    bad = ["grumbl", "snarkl", "blorft"]
    rows, labels = [], []
    for i in range(900):
        toxic = int(rnd.random() < 0.3)
        words = prose(rnd, 40).split(" ")
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(40), rnd.choice(bad) + rnd.choice(["", "er", "ing"]))
        rows.append((10000 + i, " ".join(words), "s"))
        labels.append((10000 + i, 1, toxic))
    every = rows + corpus
    label = spark.createDataFrame(labels + [(10000, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    w = toxicity.fit_on_labels(make(spark, every), label)
    assert 0 < np.count_nonzero(w) < 2000
    out = toxicity.score(make(spark, every), w).select("doc_id", "score", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert len(out) == len(every) and all(0 <= r.score <= 1 for r in out)
    truth = {d: t for d, _, t in labels}
    held = [(r.score >= 0.7, truth[r.doc_id]) for r in out if r.h and r.doc_id in truth]
    assert len(held) > 200 and sum(p == bool(t) for p, t in held) / len(held) > 0.97
    from zlib import crc32
    assert all(r.h == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
    assert toxicity.score(make(spark, []), w).count() == 0
    nothing = toxicity.fit_on_labels(make(spark, corpus), label.limit(0))
    assert {r.score for r in toxicity.score(make(spark, corpus), nothing).collect()} == {0.5}
    assert np.array_equal(w, toxicity.fit_on_labels(make(spark, every), label))


def test_pipeline_stages(spark):
    """Every stage against a brute-force version on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        path = f"{__import__('tempfile').mkdtemp(prefix='run-', dir='/tmp')}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        steps.append((name, before.collect(), docs.collect()))
        assert docs.columns == (names if name != "mix" else names + ["copy"])
    by = {n: (a, b) for n, a, b in steps}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    a, b = by["toxicity"]
    gone = {r.doc_id for r in a} - {r.doc_id for r in b}
    assert all(labels.get(d) != 0 for d in gone)
    a, b = by["line_dedup"]
    assert {r.doc_id for r in a} == {r.doc_id for r in b}
    sites = {}
    for r in a:
        for line in r.text.split("\n"):
            if line.strip(" "):
                sites.setdefault(line.strip(" "), []).append((r.source, r.doc_id))
    wide = {x: min(d for _, d in v) for x, v in sites.items() if len({s for s, _ in v}) >= 10}
    after = {r.doc_id: r.text for r in b}
    for r in a:
        want, seen = [], set()
        for line in r.text.split("\n"):
            k = line.strip(" ")
            if k not in wide or (wide[k] == r.doc_id and k not in seen):
                want.append(line)
            seen.add(k)
        assert after[r.doc_id] == "\n".join(want)
    a, b = by["simhash"]
    fp = {r.doc_id: simhash.fingerprint(r.text) for r in a}
    kept = {r.doc_id for r in b}
    for d in kept:
        assert all((fp[d] ^ fp[e]).bit_count() > 3 for e in kept if e != d)
    reach = {d: d for d in fp}
    for _ in range(6):
        reach = {d: min(reach[e] for e in fp if (fp[d] ^ fp[e]).bit_count() <= 3) for d in fp}
    assert kept == set(reach.values())
    a, b = by["decontamination"]
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in a:
        w = decontaminate.words_of(r.text)
        if set(w) & {x for i in items for x in i}:
            ids = {}
            num = [ids.setdefault(x, len(ids)) for x in w]
            leak = any(decontaminate.align(np.array([ids.get(x, -1) for x in i]), np.array(num)) >= 0.5 * len(i) for i in items if len(i) >= 3)
            assert leak == (r.doc_id not in {x.doc_id for x in b})
    a, b = by["mix"]
    copies = Counter(r.doc_id for r in b)
    rates = {r.doc_id: r["__copies"] for r in mix.mix_rates(spark.createDataFrame(a)).collect()}
    assert copies == Counter({d: c for d, c in rates.items() if c})
    assert all(sorted(r.copy for r in b if r.doc_id == d) == list(range(1, c + 1)) for d, c in list(copies.items())[:20])


def test_sql_matches(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.SQL.items():
        res = con.execute(sql)
        columns = [c[0] for c in res.description]
        df = queries.QUERIES[name](spark, SF)
        assert sorted(columns) == sorted(df.columns)
        assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, res.fetchall())), name


def test_native_operators_run_no_python(spark):
    for name in ("op1_line_dedup", "op4_mix"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_registration_without_the_subpackage(tmp_path):
    assert {n.split("_")[0] for n in entry.queries()} >= {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    shutil.copytree(os.path.join(ROOT, "articleflow"), tmp_path / "articleflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q_by_id' in q and not [n for n in q if n.startswith('op')], q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_toxicity_against_a_plain_loop(spark):
    """Weights and scores of FTRL-proximal, one coordinate at a time."""
    import math
    rnd = random.Random(14)
    rows = [(i, prose(rnd, rnd.randint(0, 30), 60) + (" vile foul" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)] + [(7, "again vile", 1), (200, None, 0)]
    df = spark.createDataFrame([(d, t, y, "x", 1) for d, t, y in rows], "doc_id long, text string, label int, o string, at int").repartition(4)
    weights = toxicity.train(df, epochs=2)
    order = {(r["doc_id"], r["label"]): (r["o"], r["t"]) for r in df.select(
        "doc_id", "label", F.xxhash64(F.col("doc_id").cast("string"), F.lit("train")).alias("o"), F.xxhash64("text").alias("t")).collect()}
    z, n, last = Counter(), Counter(), 1 << toxicity.BITS

    def weight(i):
        l1 = 0.0 if i == last else toxicity.L1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)
    for _ in range(2):
        for d, t, y in sorted(rows, key=lambda r: (*order[r[0], r[2]], r[2])):
            at = [*toxicity.features(t).tolist(), last]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
                n[i] += g * g
    want = {i: weight(i) for i in z if weight(i)}
    assert set(np.flatnonzero(weights).tolist()) == set(want) and all(abs(weights[i] - w) < 1e-9 for i, w in want.items()) and len(want) > 3
    for r in toxicity.score(df, weights).collect():
        if r["doc_id"] != 7:                                       # the id that repeats
            t = next(t for d, t, _ in rows if d == r["doc_id"])
            s = sum(weights[i] for i in toxicity.features(t).tolist()) + weights[last]
            assert abs(r["score"] - 1 / (1 + math.exp(-s))) < 1e-9


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, a further column whose name
    stages use; and an empty table."""
    rnd = random.Random(9)
    rows = [(i, "\n".join(prose(rnd, 12) for _ in range(3)), "en", f"s{i % 5}", 100, i) for i in range(40)]
    rows += [(None, None, None, None, None, None), (50, "", "en", None, 0, 1), (51, " \n\t", None, "s1", None, 2), rows[3], rows[3], (None, rows[4][1], "en", "s1", 5, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, __t long"
    for name, data in (("some", rows), ("none", [])):
        sf = str(tmp_path / name)
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(i, 1, int(i % 2)) for i in range(20)] if data else [], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, prose(rnd, 30)), (2, None)] if data else [], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        docs = spark.read.parquet(f"{sf}/documents.parquet").drop("__t").withColumn("size", F.lit(1))
        for stage_name, apply in corpus_pipeline.STAGES:
            out = apply(spark, docs, sf)
            if stage_name != "mix":
                assert out.columns == docs.columns
            out.write.parquet(f"{sf}/{stage_name}")
            docs = spark.read.parquet(f"{sf}/{stage_name}")
        assert (docs.count() > 0) == bool(data)
