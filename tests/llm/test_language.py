"""Language identification: labelling against a plain search, spans of mixed
texts, held-out accuracy, edge cases."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

from articleflow.llm import language

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": "ka ro mi tu nel", "bb": "sch ung wor tze brin", "cc": "lo que ción ña del", "ru": "при вет мир дом сло", "el": "και του λόγος με"}


def prose(rnd, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def make(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")


@pytest.fixture(scope="module")
def taught(spark):
    import random
    rnd = random.Random(2)
    rows = [(i, prose(rnd, lang, rnd.randint(1, 80)), lang) for i in range(300) for lang in [list(SYLLABLES)[i % 5]]]
    return language.learn(make(spark, [*rows, (900, None, "aa"), (901, "", "bb"), (902, "no language here", None)]).repartition(4))


def test_counts_are_whole(spark, taught):
    text = "Ab ab ñandú 1² x"
    model = language.learn(make(spark, [(1, text, "aa"), (2, "ab", "bb"), (3, text, "aa")]), bits=12)
    want = Counter()
    for w in language._WORD.findall(text) * 2:
        marked = f"\x02{w.lower()}\x03"
        want.update(g for n in range(1, 5) for g in (marked[i:i + n] for i in range(len(marked) - n + 1)) if g not in "\x02\x03")
    assert model.langs == ["aa", "bb"]
    assert round(float(np.exp(model.table[:, 0].astype(float)).sum()), 3) == 1
    size = sum(want.values()) + language.PRIOR * 4096
    row, _, bucket = language.grams(["ab"], 12)
    held = dict(zip([g for n in range(1, 5) for g in ("\x02ab\x03"[i:i + n] for i in range(5 - n)) if g not in "\x02\x03"], bucket.tolist()))
    assert np.isclose(np.exp(model.table[held["ab"], 0]) * size - language.PRIOR, want["ab"], atol=.01)
    assert language.grams(["ab"] * 3, 12)[2].tolist().count(held["ab"]) == 3
    assert language.learn(make(spark, [(1, text, None)])).langs == []
    small = language.learn(make(spark, [(i, f"w{i}", f"l{i}") for i in range(20)]), cells=20 << 9)
    assert small.bits == 9 and len(small.langs) == 20
    with pytest.raises(ValueError):
        language.learn(make(spark, [(i, f"w{i}", f"l{i}") for i in range(20)]), cells=20)


def test_viterbi_is_the_best_labelling():
    rnd = np.random.default_rng(3)
    for _ in range(150):
        scores = -rnd.integers(0, 9, (rnd.integers(1, 7), 3)).astype(np.float32)
        switch = float(rnd.integers(1, 12))

        def value(labels):
            return sum(scores[i, x] for i, x in enumerate(labels)) - switch * sum(a != b for a, b in zip(labels, labels[1:]))
        best = max(map(value, itertools.product(range(3), repeat=len(scores))))
        assert np.isclose(value(language.viterbi([scores], switch)[0].tolist()), best)
        one = language.one_language(scores, switch)
        assert one is None or np.isclose(value([one] * len(scores)), best)


def test_viterbi_across_pieces(monkeypatch):
    """Texts of many pieces, labelled together, against one step at a time."""
    rnd = np.random.default_rng(7)
    texts = [-rnd.integers(0, 9, (n, 4)).astype(np.float32) for n in (1, 63, 64, 65, 300, 1000)]

    def value(s, labels):
        return float(s[np.arange(len(s)), labels].sum() - 6 * (np.diff(labels) != 0).sum())

    def plain(s):
        best = s[0].astype(float)
        for row in s[1:]:
            best = np.maximum(best, best.max() - 6) + row
        return best.max()
    for steps in (1, 1 << 22):
        monkeypatch.setattr(language, "STEPS", steps)
        for s, labels in zip(texts, language.viterbi(texts, 6.0)):
            assert np.isclose(value(s, labels), plain(s))
    assert language.viterbi([], 6.0) == []


def test_spans_and_scripts(spark, taught):
    import random
    rnd = random.Random(5)
    labeler = language.Labeler(taught)
    first, second = prose(rnd, "aa", 40), prose(rnd, "bb", 18)
    text = f"12 {first}. -- {second}!"
    (lang, score, spans), = labeler.labels([text])
    assert lang == "aa" and 0.4 < score < 0.9 and [s["lang"] for s in spans] == ["aa", "bb"]
    assert abs(spans[0]["end"] - 3 - len(first)) < 12 and spans[-1]["end"] == 3 + len(first) + 5 + len(second)
    (lang, _, spans), = labeler.labels([prose(rnd, "ru", 3) + " 漢字 " + prose(rnd, "ru", 3)])
    assert lang == "ru" and len(spans) == 1
    assert taught.candidate[language._NAMES.index("Cyrillic")].tolist() == [x == "ru" for x in taught.langs]
    assert (taught.word_scores(["мир"])[0] == np.where(np.array(taught.langs) == "ru", 0, -language.CAP)).all()
    assert (taught.word_scores(["漢"])[0] == 0).all()


def test_cases(spark, taught):
    rows = [(1, None, "aa"), (2, "", "aa"), (3, "12 ² ½ _ !", "aa"), (4, "ka", None), (None, "schung worung", None), (5, "ka ro " * 20000, "bb"),
            (6, "при", "aa"), (4, "ka", None), (2 ** 60 + 1, "καιτου λόγος", None), (7, "ﬁ İ" + "schung " * 3, None)]
    got = language.identify(make(spark, rows).repartition(3), taught)
    assert [t for _, t in got.dtypes][:3] == ["bigint", "string", "double"]
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1
    assert [by[i][0]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[1][0]["score"] == 0
    assert len(by[4]) == 2 and by[None][0]["lang_pred"] == "bb" and by[5][0]["lang_pred"] == "aa" and by[6][0]["lang_pred"] == "ru"
    assert by[2 ** 60 + 1][0]["lang_pred"] == "el" and by[5][0]["spans"][0]["end"] == 6 * 20000 - 1
    none = language.learn(make(spark, rows).limit(0))
    assert {r["lang_pred"] for r in language.identify(make(spark, rows), none).collect()} == {"und"}
    assert language.identify(make(spark, rows).limit(0), taught).count() == 0


def test_query_on_held_out(spark):
    got = language.op13_language(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    assert got.columns.tolist() == ["doc_id", "held_out", "lang_pred", "score"]
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got["doc_id"]]).all()
    both = got.merge(docs, on="doc_id")
    held = both[both["held_out"]]
    assert len(both) == len(docs) and (held["lang"] == held["lang_pred"]).mean() > 0.98
