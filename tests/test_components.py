"""Connected components: long chains, hubs, merges, empty input."""

import random

from articleflow.operators.components import components, connected_components, groups


def _brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def test_chain_hub_and_random(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] \
        + [(rnd.randint(300, 360), rnd.randint(300, 360)) for _ in range(40)] + [(1, 1)]
    rnd.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in connected_components(df, "a", "b").collect()}
    want = {k: v for k, v in _brute([e for e in edges if e[0] != e[1]]).items()}
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "a long, b long")
    assert connected_components(df, "a", "b").count() == 0


def test_long_key_chain_is_one_component(spark):
    rows = [(i, f"k{i}") for i in range(40)] + [(i + 1, f"k{i}") for i in range(40)] + [(99, "alone")]
    lab = components(spark.createDataFrame(rows, "id long, key string"))
    got = {r.id: r.component for r in lab.collect()}
    assert all(got[i] == 0 for i in range(41)) and got[99] == 99
    assert {r["size"] for r in groups(lab).collect()} == {41}
