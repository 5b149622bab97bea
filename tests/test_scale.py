"""Steps that hold a bounded part of the input and work on no more rows than they need."""

import random
from collections import Counter

import numpy as np
import pytest

from articleflow.operators import events as EV
from articleflow.operators import similarity as SI
from articleflow.plans import catalog


@pytest.mark.parametrize("run,part", [(1 << 22, 1 << 21), (300, 64)])
def test_shared_shingles_are_counted_in_runs(spark, monkeypatch, run, part):
    """Exactly the shingles of two classes or more, by a few large rows."""
    monkeypatch.setattr(SI, "RUN", run)
    monkeypatch.setattr(SI, "PART", part)
    rnd = random.Random(5)
    sets = [sorted({rnd.randrange(-1 << 62, 1 << 62) for _ in range(20)} | {rnd.randrange(40) * 97 for _ in range(6)} | {-7}) for _ in range(80)]
    df = spark.createDataFrame([(f"{k:032x}", len(x), x) for k, x in enumerate(sets)], "c string, n long, sh array<long>").repartition(3)
    often = Counter(s for x in sets for s in x)
    out = SI._twice(df)
    assert sorted(r["s"] for r in out.collect()) == sorted(s & (1 << SI.WIDE) - 1 for s, k in often.items() if k > 1)
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert SI._twice(df.where("n < 0")).count() == 0


def test_only_members_of_groups_get_vectors(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join(words[:-1] + [f"x{k}"])) for k in range(3)] + [(k, " ".join(f"t{k}x{i}" for i in range(30))) for k in range(10, 30)]
    spark.createDataFrame([(i, t, "en", f"src{i}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen, keep = [], EV.hash_vectors
    monkeypatch.setattr(EV, "hash_vectors", lambda df, *a: (seen.extend(r[0] for r in df.select("id").collect()), keep(df, *a))[1])
    got = catalog.events(spark, str(tmp_path)).collect()
    assert sorted(seen) == [0, 1, 2]
    assert [(r["cluster"], r["size"], r["n_sources"]) for r in got] == [(0, 3, 3)]


def test_vectors_of_repeated_ids_without_an_aggregate(spark, monkeypatch):
    """Counts are summed over the rows of an id, null ids too, however batches cut them."""
    rnd = random.Random(8)
    rows = [(None if k % 7 == 0 else k % 50 if k % 3 else 1000 + k, None if k % 31 == 0 else " ".join(rnd.choice(["ab", "Abc", "x", "가나", "--", "q9"]) for _ in range(k % 9))) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    monkeypatch.setattr("articleflow.session.TEXT_ROWS", 7)
    for dim in (256, 31):
        out = EV.hash_vectors(df, "id", EV.F.col("t"), dim)
        assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()
        want = Counter()
        for r in df.select("id", EV.hash_buckets("t", dim).alias("b")).collect():
            want.update((r["id"], x) for x in r["b"])
        norm = Counter()
        for (i, _), n in want.items():
            norm[i] += n * n
        got = out.collect()
        assert len(got) == len(want) and out.dtypes == [("id", "bigint"), ("idx", "int"), ("w", "double")]
        assert {(r["id"], r["idx"]): r["w"] for r in got} == {(i, x): n / np.sqrt(norm[i]) for (i, x), n in want.items()}


def test_tokens_are_hashed_once_for_a_task(spark, monkeypatch):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["alpha", "beta", "가나다", "x", "q9--"]) for _ in range(200)) for _ in range(30)] + ["", "--"]
    known, hashed = EV.TokenBuckets(256), []
    bucket = known._bucket
    known._bucket = lambda gram: (hashed.append(gram), bucket(gram))[1]
    found = [known.count(t) for t in texts]
    assert len(hashed) < 40
    want = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").select("k", EV.hash_buckets("t").alias("b")).collect()
    monkeypatch.setattr(EV, "KNOWN", 4)                          # forgets all the time
    again = [known.count(t) for t in texts]
    for r in want:
        for got in (found, again):
            assert dict(zip(*(x.tolist() for x in got[r["k"]]))) == Counter(r["b"])
    assert EV.hash_vectors(spark.createDataFrame([(1, "a")], "id long, t string"), "id", EV.F.col("t"))._jdf.queryExecution().toString().count("md5") == 0


def test_only_members_of_groups_are_summarised(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join(words[:-1] + [f"x{k}"])) for k in range(3)] + [(k, " ".join(f"t{k}x{i}" for i in range(30))) for k in range(10, 200)]
    spark.createDataFrame([(i, t, "en", f"src{i}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen, keep = [], catalog.V.summaries_view
    monkeypatch.setattr(catalog.V, "summaries_view", lambda *a, **k: (seen.append(k["documents"].count()), keep(*a, **k))[1])
    got = catalog.event_top(spark, str(tmp_path)).collect()
    assert seen == [3]
    assert [(r["cluster"], r["size"], r["n_sources"]) for r in got] == [(0, 3, 3)]


def test_representatives_move_a_row_for_a_member(spark):
    """The member nearest to the mean of its cluster, against brute force; buckets are exploded for the sums only."""
    rnd = np.random.default_rng(3)
    rows = [("b", k % 5, k, k % 97, *zip(*sorted((int(d), float(rnd.random())) for d in rnd.choice(40, rnd.integers(1, 9), replace=False)))) for k in range(120)]
    rows += [("b", 7, 200 + k, k, [1, 2], [.6, .8]) for k in range(3)]                           # equal vectors: the first position
    rows += [("b", 1, 300, 0, None, None), ("b", 8, 301, 0, None, None), ("b", 2, 2, 2, *rows[2][4:]), ("c", 1, 1, 1, [3], [0.0])]
    df = spark.createDataFrame([(a, b, c, d, None if e is None else list(e), None if f is None else list(f)) for a, b, c, d, e, f in rows],
                               "blk string, cluster long, id long, pos long, idx array<int>, w array<double>")
    out = EV.representatives(df, ["blk"])
    want = {}
    for key in {r[:2] for r in rows}:
        own, sims = [r for r in rows if r[:2] == key], Counter()
        vecs = np.zeros((len(own), 40))
        for k, r in enumerate(own):
            vecs[k, list(r[4] or [])] = r[5] or []
        mean = vecs.mean(axis=0)
        for v, r in zip(vecs, own):
            if r[4]:
                sims[r[2], r[3]] += v @ mean / (np.linalg.norm(mean) or 1)
        if sims:
            want[key] = min(sims, key=lambda m: (-round(sims[m], 9), m[1]))[0]
    assert {(r["blk"], r["cluster"]): r["rep_id"] for r in out.collect()} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
