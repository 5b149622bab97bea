import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, component_id string, __t2 string"


def make(spark, rows):
    """documents with further columns whose names operators use themselves."""
    full = [(d, t, "en", s, len(t) if t is not None else None, 7, "x", "y") for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rnd, words, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}{'abcdefg'[rnd.randrange(7)]}" for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source): prose, copies, near copies, shared passages,
    footers, nulls, empty and white texts, a long text, a repeated row and a
    repeated doc_id, rows without doc_id."""
    rnd = random.Random(3)
    rows = [(i, "\n".join(prose(rnd, rnd.randint(3, 60)) for _ in range(rnd.randint(1, 5))), f"s{i % 13}") for i in range(60)]
    passage, footer = prose(rnd, 60), "All rights reserved by the site."
    for i in range(60, 84):
        rows.append((i, f"{prose(rnd, 30)}\n{passage}\n{prose(rnd, 8)}\n{footer}", f"s{i % 13}"))
    rows += [(100 + i, rows[5][1], f"s{i}") for i in range(4)]                       # exact copies
    words = rows[7][1].split(" ")
    for i in range(4):
        w = list(words)
        w[i % len(w)] = "edited"
        rows.append((110 + i, " ".join(w), None))
    rows += [(120, None, "s1"), (121, "", "s1"), (122, " \t\n ", None), (123, prose(rnd, 20000, 10 ** 6), "s2"),
             (124, "ab" * 300, "s2"), (125, "Straße ÀÉ ▁   x", "s3"), (126, "one two", "s3"),
             (5, rows[5][1], "s5"), (5, prose(rnd, 40), "s5"), (None, "no id at all here", "s1"), (None, rows[5][1], "s1"),
             (127, passage[:180] + " " + passage[150:], "s4")]
    return rows
