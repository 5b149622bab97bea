"""Similarity groups against all pairs, cosine links against all pairs."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from articleflow.operators import similarity as SI


def shingle_set(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {("short", " ".join(w))} if w else set()


def brute(rows, t, n=5):
    sets = [(i, shingle_set(x, n)) for i, x in rows if i is not None]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if sets[a][0] == sets[b][0] or x and y and Fraction(len(x & y), len(x | y)) >= Fraction(str(t)):
                parent[find(a)] = find(b)
    low, size = {}, Counter(find(k) for k in range(len(sets)))
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return Counter((i, low[find(k)], size[find(k)]) for k, (i, _) in enumerate(sets))


def corpus(rnd):
    def prose(n, v=200):
        return [f"w{rnd.randrange(v)}" for _ in range(n)]
    rows = [(i, " ".join(prose(rnd.randint(0, 40)))) for i in range(60)]
    base = prose(60)
    for i in range(100, 160):                                   # a chain of near copies, a step is one word
        w = list(base)
        for k in range(i - 100):
            w[(k * 7) % 60] = f"x{k}"
        rows.append((i, " ".join(w)))
    hub = prose(120)
    for i in range(200, 290):                                   # a large group of near copies
        w = list(hub)
        w[rnd.randrange(120)] = f"y{i}"
        rows.append((i, "\t ".join(w)))
    rows += [(300 + i, rows[3][1].upper()) for i in range(30)] + [(400, None), (401, ""), (402, " \n "), (403, "one two"), (404, "One  two"), (405, "one two three")]
    foot = prose(30)
    rows += [(500 + i, " ".join(foot + prose(8 + i % 3, 10 ** 6))) for i in range(60)]      # a common passage, below and above the threshold
    return rows + [(None, "no id here at all today"), (7, rows[8][1]), (9, rows[9][1])]


@pytest.mark.parametrize("threshold,n", [(0.8, 5), (0.6, 5), (0.9, 3), (1.0, 5)])
def test_groups(spark, threshold, n):
    rows = corpus(random.Random(3))
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "id long, text string, component long, c string").repartition(5)
    got = SI.similar_groups(df, threshold=threshold, size=n)
    assert got.dtypes == [("id", "bigint"), ("component", "bigint"), ("size", "bigint")]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, threshold, n)


def test_shingles_of_many_texts_at_a_time():
    """Sets of hashes that agree with sets of words, whatever text comes before."""
    rnd = random.Random(12)
    vocabulary = ["a", "B", "b", "Ä", "ä", "x" * 48, "x" * 49, "x" * 49 + "y", "X" * 49, "가\x00", "\u00a0", "ab" * 40, "ba" * 40]
    texts = ["".join(rnd.choice(vocabulary) + rnd.choice([" ", "\t", "\n ", "\x0b"]) for _ in range(rnd.randint(0, 12))) for _ in range(300)] + ["", " ", " a", "B b  b b\fb"]
    for n in (1, 3, 5):
        want, got = [shingle_set(t, n) for t in texts], SI.shingles_of([t.encode() for t in texts], n)
        assert [x.tolist() for x in got] == [sorted(set(x.tolist())) for x in got] == [SI.shingles(t, n).tolist() for t in texts]
        assert [len(x) for x in got] == [len(x) for x in want]
        for a in range(0, len(texts), 7):
            assert [len(np.intersect1d(got[a], x)) for x in got] == [len(want[a] & x) for x in want]


def test_empty_and_bounds(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert SI.similar_groups(df).count() == 0
    pairs, members, report = SI.cosine_links(df.selectExpr("id", "array(1.0D) AS vector"), 0.5)
    assert pairs.count() == 0 and members.count() == 0 and report == {"block_pairs": 0, "compared": 0}
    with pytest.raises(ValueError):
        SI.similar_groups(df, threshold=0)


def test_a_hot_shingle_emits_few_pairs(spark, monkeypatch):
    """A group of near copies is joined by its leaders, not by all pairs."""
    seen, keep = [], SI._similar
    monkeypatch.setattr(SI, "_similar", lambda pairs, *a: (seen.append(pairs.count()), keep(pairs, *a))[1])
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i % 190] + [f"n{i}"] + base[i % 190 + 1:])) for i in range(600)]
    got = SI.similar_groups(spark.createDataFrame(rows, "id long, text string"))
    assert {tuple(r)[1:] for r in got.collect()} == {(0, 600)}
    assert sum(seen) < 600 * 60                                  # all pairs: 179,700


def links(rows, t):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    classes = {}
    for i, v in ok:
        classes.setdefault(tuple(v), []).append(i)
    reps = [(min(ids), np.array(v) / np.linalg.norm(v)) for v, ids in classes.items()]
    pairs = {(min(a, b), max(a, b)) for k, (a, x) in enumerate(reps) for b, y in reps[:k] if len(x) == len(y) and x @ y >= t}
    return pairs, {(i, min(ids)) for ids in classes.values() for i in ids}


def test_cosine_links(spark):
    rnd = np.random.default_rng(4)
    centers = rnd.normal(size=(9, 12)) * 3
    rows = [(i, (centers[i % 9] + rnd.normal(size=12) * .4).tolist()) for i in range(500)]
    rows += [(600 + i, rows[5][1]) for i in range(40)] + [(700, None), (701, [None] * 12), (702, [float("nan")] * 12), (703, [float("inf")] * 12),
                                                         (704, [0.0] * 12), (705, []), (None, rows[0][1]), (706, [1.0, 2.0]), (707, [2.0, 4.1]), (708, [-1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "id long, vector array<double>, c int, a int").repartition(6)
    for threshold, block in ((0.95, 20), (0.3, 64), (0.3, 5000)):
        pairs, members, report = SI.cosine_links(df, threshold, pivots=8, block=block)
        want, classes = links(rows, threshold)
        assert {(r["a"], r["b"]) for r in pairs.collect()} == want and pairs.count() == len(want)
        assert {tuple(r) for r in members.collect()} == classes
        if block == 20:
            assert report["compared"] < report["block_pairs"] / 3       # the bounds prune before vectors move


def test_own_shingles_keep_texts_apart(spark):
    """Texts that share a passage but hold enough shingles of their own have no
    prefix shingle to share, so none of their sets is compared."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(k, passage + " " + " ".join(f"t{k}x{i}" for i in range(60))) for k in range(40)]
    rows += [(100, " ".join(f"z{i}" for i in range(60))), (101, " ".join(f"z{i}" for i in range(59)))]
    df = spark.createDataFrame(rows, "id long, text string")
    live = SI._prefixes(SI.shingle_sets(df, "id", "text").select("c", "n", "sh"), 4, 5)
    assert live.select("c").distinct().count() == 2
    out = {r["id"]: (r["component"], r["size"]) for r in SI.similar_groups(df).collect()}
    assert out[100] == out[101] == (100, 2) and all(out[k] == (k, 1) for k in range(40))
