"""Conversation repair against a plain search over (turn, state)."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb

from articleflow.llm import alternation, conversations

FAR = (10 ** 9, "", ())


def least(turns):
    """(cost, audit, lines) by dynamic programming over states; ``turns``:
    (role, text, fault)."""
    def close(b):
        for _ in range(3):
            for s in range(4):
                need, to = ("a", 3) if s == 2 else ("u", 2)
                if b[to][0] < 10 ** 9:
                    b[s] = min(b[s], (b[to][0] + 2, "I" + b[to][1], ({"u": "user:", "a": "assistant:"}[need],) + b[to][2]))
        return b
    after = close({0: (0, "", ()), 1: FAR, 2: FAR, 3: (0, "", ())})
    for role, text, fault in reversed(turns):
        now = {}
        for s in range(4):
            options = [(after[s][0] + 3, "D" + after[s][1], after[s][2])]
            if fault not in ("b", "d"):
                paid, first = int(fault == "t"), role[:1]
                if s == 0 and first == "s":
                    options.append((after[1][0] + paid, "K" + after[1][1], (f"{role}:{text}",) + after[1][2]))
                need, to, name = ("a", 3, "assistant") if s == 2 else ("u", 2, "user")
                kept = first == need
                line = f"{role}:{text}" if kept else f"{name}:{text}"
                options.append((after[to][0] + paid + (0 if kept else 2), ("K" if kept else "R") + after[to][1], (line,) + after[to][2]))
            now[s] = min(options)
        after = close(now)
    return after[0]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            name = ":".join(" " if v is None else str(v) for v in (c, turn))
            f = zlib.crc32(name.encode()) % 20
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            damaged += [(turn, "user" if f == 4 else role, text)] * {0: 0, 3: 2}.get(f, 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, turns = set(), []
        for turn, role, text in damaged:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
            seen.add((role, text))
            turns.append((role, text, fault))
        known = [t for t, _, _ in damaged if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
        cost, audit, lines = least(turns)
        count = Counter(f for _, _, f in turns)
        out[conv] = (gaps, count["b"], count["d"], count["t"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk(rnd, conv, n):
    rows, roles = [], ["user", "assistant"]
    if rnd.random() < .5:
        rows.append((conv, 0, "system", "Be kind."))
    for t in range(1, n):
        role = roles[t % 2 == 0] if rnd.random() < .85 else rnd.choice(["system", "tool", "user", "assistant", "", None, "User"])
        text = rnd.choice([f"Text {rnd.randrange(10 ** 6)}.", f"w{rnd.randrange(30)}", "Yes!", "", " \t", None, "é ", f"End {t}? \n"])
        rows.append((conv, rnd.choice([t, t, t, t + 1, None]) if rnd.random() < .2 else t, role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, k string, ord int, audit string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def check(frame, want):
    got = {r[0]: tuple(r[1:]) for r in frame.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == want


def test_alignment():
    rnd = random.Random(1)
    for _ in range(1500):
        kinds = rnd.choice(["suaUAx", "sSuaoOUAxx", "uauaua", "ssss", "aaau", "xxxus"])
        codes = "".join(rnd.choice(kinds) for _ in range(rnd.randint(0, 11)))
        name = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": ""}
        turns = [(name[c.lower()], str(i), "b" if c == "x" else "t" if c.isupper() else "-") for i, c in enumerate(codes)]
        cost, audit, lines = least(turns)
        assert alternation.align(codes)[:2] == (cost, audit)
        own = [(r, t) for r, t, f in turns if f != "b"]
        assert tuple(f"{r}:{t}" for r, t in alternation.apply(audit, [r for r, _ in own], [t for _, t in own], codes)) == lines


def test_band_is_narrow():
    band = alternation.Band("ua" * 200, alternation.ASSISTANT, 6, True)
    assert band.rows.shape[1] < 8 and band.at(400, 400) == 0


def test_repair(spark):
    rnd = random.Random(4)
    rows = [r for c in range(60) for r in talk(rnd, c, rnd.randint(1, 14))]
    rows += talk(rnd, 900, 700) + talk(rnd, None, 40) + [(901, 5, "user", "Again.")] * 90 + [(902, t, "user", "Same.") for t in range(80)]
    rows += [(903, None, None, None), (904, 1, "user", None), (905, 2 ** 60, "user", "Hi."), (905, 2 ** 60 + 3, "assistant", "Ho.")]
    want, df = brute(rows), make(spark, rows).repartition(6)
    damaged, names = conversations.damage(df), conversations._turns(df)
    check(conversations.digests(conversations.repair(damaged), names), want)
    check(conversations.digests(conversations.repair(damaged, size=5), names), want)      # many segments, borders anywhere
    lines = {}
    for r in sorted(conversations.repaired_turns(damaged, size=7).collect(), key=lambda r: (r["ord"], r["pos"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]
    assert conversations.digests(conversations.repair(damaged.limit(0)), names.limit(0)).count() == 0


def test_sql(spark, tmp_path):
    rnd = random.Random(6)
    rows = [r for c in range(80) for r in talk(rnd, c, rnd.randint(1, 9)) if r[1] is not None]
    df = make(spark, rows).select("conv_id", "turn", "role", "text")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = {r[0]: r[1:] for r in con.execute(conversations.SQL).fetchall()}
    check(conversations.op12_conversations(spark, str(tmp_path)), want)
    assert want == brute(rows)
