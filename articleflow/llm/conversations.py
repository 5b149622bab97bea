"""Conversation structure repair: the cheapest edits that turn each
conversation into ``(system? (user assistant)+)?``, by Wagner-Fischer alignment
to every feasible length of the alternating string (alternation.py).

Turns are read in the order (turn with nulls first, role, text); a null role
or text counts as one blank.  Fault of a turn, the first of: blank (no
character but ASCII white space), duplicate (role and text stand earlier in the
conversation), truncated (last such character is none of ``.!?``).  Blank and
duplicate turns must go; a truncated turn that stays costs 1.

On Spark: equal rows are counted first, so a third of all rows being one row
is one row with a count.  The first place of every (conversation, role, text)
is an aggregate joined back.  Range partitioning by (conversation, order) then
spreads even one conversation that holds a third of all rows, and each task
cuts its sorted rows into segments of at most SEGMENT turns and BYTES bytes of
text.  A conversation of one segment is aligned where it lies.  For the others
each segment gives its least cost between any two states (16 numbers), two
scans over these (within a partition, then across partitions) give the cost of
what follows and the state that each segment starts from, and every segment is
then aligned on its own; the audits join up to the one of the whole.

Digests read a conversation's segments in order as a stream, so the texts of a
long conversation never lie in memory at once.

Defined cases: a conversation without any turn left has zeros, an empty audit
and the hash of the empty string; rows without a conv_id are one conversation
(conv_id null); a role that starts with none of ``s``, ``u``, ``a`` (the empty
role too) is never kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import alternation
from .common import table

#: Turns and bytes of text in a segment.
SEGMENT, BYTES = 256, 1 << 16
#: ASCII white space.
WHITE = r" \t\n\x0B\f\r"
LEGAL = ("su", "ua", "au")
NONE = " "    # the name of the conversation without conv_id (ids are numbers)


def _turns(conversations: DataFrame) -> DataFrame:
    """(k, turn, role, text) with nulls filled; k names the conversation."""
    return conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(NONE)).alias("k"), F.col("turn").cast("long"),
                                F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def damage(conversations: DataFrame) -> DataFrame:
    """Seeded faults, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the
    turn, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a
    user turn."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("__f", F.crc32(name.cast("binary")) % 20).where("__f <> 0")
    text = F.when(F.col("__f") == 1, "").when(F.col("__f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text).withColumn("role", F.when(F.col("__f") == 4, "user").otherwise(F.col("role")))
    copies = F.explode(F.when(F.col("__f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("__copy", copies).drop("__f", "__copy")


def _judged(turns: DataFrame) -> DataFrame:
    """Distinct turns with their number n, role initial and fault (b, d, t or -;
    further equal turns are duplicates)."""
    counted = stage(turns.groupBy("k", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("h", F.sha2("text", 256)), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("at"))
    first = counted.groupBy(F.col("k").alias("k1"), F.col("role").alias("r1"), F.col("h").alias("h1")).agg(F.min(place).alias("p1"))
    both = counted.join(first, (F.col("k") == F.col("k1")) & (F.col("role") == F.col("r1")) & (F.col("h") == F.col("h1")))
    body = F.expr(f"trim(TRAILING '{WHITE}' FROM text)")
    fault = F.when(body == "", "b").when(place != F.col("p1"), "d").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    return both.select("k", "turn", "role", "text", "n", fault.alias("fault"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"))


_SEGMENT = ("k string, ord long, codes string, initials string, roles array<string>, texts array<string>, "
            "blank long, duplicate long, truncated long, lo long, hi long, turns long")


def segments(turns: DataFrame, size: int = SEGMENT, most: int = BYTES) -> DataFrame:
    """The turns of each conversation in order, in pieces: codes of all turns,
    roles and texts of those that need not go, counts of faults, least,
    greatest and number of the distinct turn numbers (0, 0, 0 without any)."""
    order = ["k", "turn", "role", "text"]
    rows = stage(_judged(turns), "turns-judged").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, number, key, heavy = [], TaskContext.get().partitionId() << 32, None, 0
        cur: dict = {}

        def close() -> None:
            nonlocal number, cur, heavy
            if cur:
                done.append((key, number, "".join(cur["codes"]), "".join(cur["initials"]), cur["roles"], cur["texts"], cur["b"], cur["d"], cur["t"],
                             cur["lo"], cur["hi"], cur["turns"]))
                number += 1
            cur, heavy = {}, 0

        for b in batches:
            for k, turn, unset, role, text, n, fault, initial in zip(b["k"], b["turn"], b["unset"], b["role"], b["text"], b["n"], b["fault"], b["initial"]):
                if k != key:
                    close()
                    key = k
                for copy in range(n):
                    if cur and (len(cur["codes"]) >= size or heavy >= most):
                        close()
                    if not cur:
                        cur = {"codes": [], "initials": [], "roles": [], "texts": [], "b": 0, "d": 0, "t": 0, "lo": 0, "hi": 0, "turns": 0}
                    own = fault if copy == 0 or fault == "b" else "d"
                    cur["initials"].append(initial)
                    if own in "bd":
                        cur["codes"].append("x")
                        cur[own] += 1
                    else:
                        cur["codes"].append(initial.upper() if own == "t" else initial)
                        cur["t"] += own == "t"
                        cur["roles"].append(role)
                        cur["texts"].append(text)
                        heavy += len(text)
                    if not unset and (not cur["turns"] or turn != cur["hi"]):
                        cur["lo"] = cur["lo"] if cur["turns"] else turn
                        cur["hi"] = turn
                        cur["turns"] += 1
                    if len(done) >= 512:
                        yield _frame(done, _SEGMENT)
                        done.clear()
        close()
        if done:
            yield _frame(done, _SEGMENT)
    flat = rows.select("k", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("unset"), "role", "text", "n", "fault", "initial")
    return flat.mapInPandas(run, _SEGMENT)


def _frame(rows: list, schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def scan(items: DataFrame, combine, start: list[int], reverse: bool = False) -> DataFrame:
    """Exclusive scan within each k in the order of ``ord``: (k, ord, y), y the
    combination (associative) of ``start`` and the x (array of long) of all
    items before, or of all items after and ``start``.  Items of a partition
    (ord >> 32) are combined first, so a task sees the items of one partition or one
    row for each partition."""
    kind = "k string, ord long, y array<long>"

    def ordered(pdf: pd.DataFrame, by: str) -> pd.DataFrame:
        return pdf.sort_values(by, ascending=not reverse)

    def add(y: list[int], x) -> list[int]:
        return combine(list(x), y) if reverse else combine(y, list(x))

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = ordered(pdf, "ord")["x"].tolist()
        y = list(rows[0])
        for x in rows[1:]:
            y = add(y, x)
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "ord": [pdf["part"].iloc[0]], "y": [y]})

    def before(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, y, out = ordered(pdf, "ord"), list(pdf["y0"].iloc[0]) if "y0" in pdf else start, []
        for x in pdf["x"]:
            out.append(y)
            y = add(y, x)
        return pd.DataFrame({"k": pdf["k"], "ord": pdf["ord"], "y": out})

    items = items.select("k", "ord", "x", F.shiftright("ord", 32).alias("part"))
    totals = items.groupBy("k", "part").applyInPandas(total, kind)
    across = totals.withColumnRenamed("y", "x").groupBy("k").applyInPandas(before, kind)
    each = items.join(across.select("k", F.col("ord").alias("part"), F.col("y").alias("y0")), ["k", "part"])
    return each.groupBy("k", "part").applyInPandas(before, kind)


def _min_plus(a: list[int], b: list[int]) -> list[int]:
    """Costs of two segments in a row (4 x 4 each), or of a segment and what follows (4)."""
    left, right = np.array(a, np.int64).reshape(4, 4), np.array(b, np.int64).reshape(4, -1)
    return np.minimum((left[:, :, None] + right[None, :, :]).min(axis=1), alternation.FAR).ravel().tolist()


def _chain(a: list[int], b: list[int]) -> list[int]:
    """End state of two segments in a row for each start state (-1: none)."""
    return [b[s] if s >= 0 else -1 for s in a]


def borders(pieces: DataFrame) -> DataFrame:
    """(k, ord, entry, goal, ends) of the segments of conversations of several."""
    per = pieces.groupBy("k").agg(F.count(F.lit(1)).alias("__n"), F.max("ord").alias("__last"))
    many = stage(pieces.select("k", "ord", "codes").join(per.where("__n > 1"), "k"), "segments-many")

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["k", "ord"]].assign(x=[alternation.costs(c).ravel().tolist() for c in b["codes"]])
    costs = stage(many.select("k", "ord", "codes").mapInPandas(matrices, "k string, ord long, x array<long>"), "segments-costs")
    close = [0, 2 * alternation.INSERT, alternation.INSERT, 0]      # after the last turn
    goals = scan(costs, _min_plus, close, reverse=True).withColumnRenamed("y", "goal")
    todo = stage(many.join(goals, ["k", "ord"]), "segments-goals")

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["k", "ord"]].assign(x=[_ends(c, tuple(g.tolist())) for c, g in zip(b["codes"], b["goal"])])
    ends = todo.select("k", "ord", "codes", "goal").mapInPandas(maps, "k string, ord long, x array<long>")
    entries = scan(stage(ends, "segments-ends"), _chain, [0, 1, 2, 3]).select("k", "ord", F.col("y")[0].cast("int").alias("entry"))
    return stage(todo.join(entries, ["k", "ord"]).select("k", "ord", "entry", "goal", (F.col("ord") == F.col("__last")).alias("closes")), "segments-borders")


def _ends(codes: str, goal: tuple) -> list[int]:
    out = []
    for p in range(4):
        cost, _, end = alternation.align(codes, p, goal, False)
        out.append(end if cost < alternation.FAR else -1)
    return out


_REPAIRED = ("k string, ord long, audit string, cost long, repaired array<struct<role:string,text:string>>, initials string, "
             "blank long, duplicate long, truncated long, lo long, hi long, turns long")


def repair(conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The repaired conversations, in segments: (k, ord) in order, the edits of
    each (audit), their cost, the repaired turns, and what the faults were."""
    pieces = stage(segments(_turns(conversations), size), "segments")
    known = borders(pieces).select(F.col("k").alias("__k"), F.col("ord").alias("__o"), "entry", "goal", "closes")
    todo = pieces.join(known, (F.col("k") == F.col("__k")) & (F.col("ord") == F.col("__o")), "left")
    todo = todo.select(pieces["*"], F.coalesce("entry", F.lit(0)).alias("entry"), "goal", F.coalesce("closes", F.lit(True)).alias("closes"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cost, audit, turns = [], [], []
            for codes, roles, texts, entry, goal, closes in zip(b["codes"], b["roles"], b["texts"], b["entry"], b["goal"], b["closes"]):
                c, a, _ = alternation.align(codes, entry, alternation.WHOLE if closes else tuple(goal.tolist()), bool(closes))
                cost.append(c)
                audit.append(a)
                turns.append([{"role": r, "text": t} for r, t in alternation.apply(a, list(roles), list(texts), codes, entry)])
            yield b[["k", "ord", "initials", "blank", "duplicate", "truncated", "lo", "hi", "turns"]].assign(cost=cost, audit=audit, repaired=turns)
    return todo.mapInPandas(run, _REPAIRED)


def repaired_turns(conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, ord, pos, role, text): the turns of the repaired conversations,
    in the order (ord, pos)."""
    out = repair(conversations, size).select("k", "ord", F.posexplode("repaired").alias("pos", "t"))
    return out.select(F.expr(f"IF(k = '{NONE}', NULL, CAST(k AS BIGINT))").alias("conv_id"), "ord", "pos", "t.role", "t.text")


_DIGEST = ("k string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def digests(repaired: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each conversation of ``names`` (k): counts, cost, audit and
    hash, from its segments read in order."""
    zero = [F.lit(0).cast("long").alias(c) for c in ("cost", "blank", "duplicate", "truncated", "lo", "hi", "turns")]
    empty = names.select("k").distinct().select("k", F.lit(-1).cast("long").alias("ord"), *zero)
    rows = repaired.unionByName(empty, allowMissingColumns=True).repartition("k").sortWithinPartitions("k", "ord")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, key, cur = [], None, None

        def close() -> None:
            if cur is not None:
                gaps = cur["hi"] - cur["lo"] + 1 - cur["turns"] if cur["turns"] else 0
                done.append((key, gaps, *cur["faults"], cur["illegal"], cur["cost"], "".join(cur["audit"]), cur["sha"].hexdigest()))
        for b in batches:
            numbers = b[["blank", "duplicate", "truncated", "cost", "lo", "hi", "turns"]].to_numpy(np.int64).tolist()
            for k, order, audit, initials, repaired, row in zip(b["k"], b["ord"], b["audit"], b["initials"], b["repaired"], numbers):
                *faults, cost, lo, hi, turns = row
                if k != key:
                    close()
                    key, cur = k, {"faults": [0, 0, 0], "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False,
                                   "lo": 0, "hi": 0, "turns": 0, "initial": ""}
                if order < 0:
                    continue
                cur["faults"] = [x + y for x, y in zip(cur["faults"], faults)]
                line = cur["initial"] + initials
                cur["illegal"] += sum(line[i:i + 2] not in LEGAL for i in range(len(line) - 1))
                cur["initial"] = initials[-1]
                cur["cost"] += cost
                cur["audit"].append(audit)
                for t in repaired:
                    cur["sha"].update((("\n" if cur["any"] else "") + f"{t['role']}:{t['text']}").encode())
                    cur["any"] = True
                if turns:
                    again = cur["turns"] and cur["hi"] == lo
                    cur["lo"], cur["hi"], cur["turns"] = cur["lo"] if cur["turns"] else lo, hi, cur["turns"] + turns - bool(again)
            if len(done) >= 512:
                yield _frame(done, _DIGEST)
                done.clear()
        close()
        if done:
            yield _frame(done, _DIGEST)
    flat = rows.select("k", "ord", "audit", "cost", "initials", "repaired", "blank", "duplicate", "truncated", "lo", "hi", "turns")
    out = flat.mapInPandas(run, _DIGEST)
    return out.select(F.expr(f"IF(k = '{NONE}', NULL, CAST(k AS BIGINT))").alias("conv_id"), *[c for c in out.columns if c != "k"])


def op12_conversations(spark, sf_dir):
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conversation, after seeded damage."""
    rows = table(spark, sf_dir, "conversations")
    return digests(repair(damage(rows)), _turns(rows))


def _sql() -> str:
    """DuckDB SQL of the query: a recursion over each conversation's turns from
    the last one, with the best (cost, audit, lines) from each of the four
    states; structs compare field by field, so ties go to the first audit."""
    def edit(cost: str, letter: str, line: str, rest: str) -> str:
        return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 't': {line} || {rest}.t}}"

    def best(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"
    far = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
    kept, line = "t.truncated::BIGINT", "chr(10) || t.role || ':' || t.text"
    new = {"u": "chr(10) || 'user:'", "a": "chr(10) || 'assistant:'"}

    def stay(need: str, to: str) -> str:
        keep = edit(kept, "K", line, f"n.{to}")
        role = edit(f"2 + {kept}", "R", f"{new[need]} || t.text", f"n.{to}")
        return f"CASE WHEN t.fault IN ('b', 'd') THEN {far} WHEN t.initial = '{need}' THEN {keep} ELSE {role} END"
    system = f"CASE WHEN t.fault IN ('b', 'd') OR t.initial <> 's' THEN {far} ELSE {edit(kept, 'K', line, 'n.v1')} END"
    drop = {v: edit("3", "D", "''", f"n.{v}") for v in ("v0", "v1", "v2", "v3")}
    close = {"v2": best("b.v2", edit("2", "I", new["a"], "b.v3")), "v3": best("b.v3", edit("2", "I", new["u"], "b.v2"))}
    return f"""
WITH RECURSIVE steps AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) AS r(i)),
sums AS (SELECT list(v ORDER BY i) AS t FROM steps),
marked AS (SELECT c.conv_id, c.turn, coalesce(c.role, ' ') AS role, coalesce(c.text, ' ') AS text, sums.t AS t,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes
  FROM conversations c, sums),
hit AS (SELECT conv_id, turn, role, text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS f FROM marked),
damaged AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(2) AS r(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM numbered),
turns AS (SELECT *, CASE WHEN tail = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN tail NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
    (nth = 1 AND tail NOT IN ('', '.', '!', '?')) AS truncated, CASE WHEN role[1:1] IN ('s', 'u', 'a') THEN role[1:1] ELSE 'o' END AS initial FROM placed),
sizes AS (SELECT conv_id, max(i) AS n FROM turns GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS v0, {{'c': 4::BIGINT, 'a': 'II', 't': {new['u']} || {new['a']}}} AS v1,
    {{'c': 2::BIGINT, 'a': 'I', 't': {new['a']}}} AS v2, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS v3 FROM sizes
  UNION ALL
  SELECT conv_id, i, {best('b.v0', edit('2', 'I', new['u'], 'v2'))}, {best('b.v1', edit('2', 'I', new['u'], 'v2'))}, v2, v3
  FROM (SELECT b.conv_id, b.i, b, {close['v2']} AS v2, {close['v3']} AS v3
    FROM (SELECT n.conv_id, n.i - 1 AS i, {best(drop['v0'], system, stay('u', 'v2'))} AS v0, {best(drop['v1'], stay('u', 'v2'))} AS v1,
        {best(drop['v2'], stay('a', 'v3'))} AS v2, {best(drop['v3'], stay('u', 'v2'))} AS v3
      FROM walk n JOIN turns t ON n.conv_id IS NOT DISTINCT FROM t.conv_id AND n.i = t.i) b)),
pairs AS (SELECT conv_id, initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM turns),
illegal AS (SELECT conv_id, count(*) AS illegal FROM pairs WHERE p IS NOT NULL AND p NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated FROM turns GROUP BY conv_id)
SELECT c.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank, coalesce(f.duplicate, 0)::BIGINT AS duplicate,
  coalesce(f.truncated, 0)::BIGINT AS truncated, coalesce(x.illegal, 0)::BIGINT AS illegal, coalesce(w.v0.c, 0)::BIGINT AS cost,
  coalesce(w.v0.a, '') AS audit, sha256(coalesce(w.v0.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN illegal x ON c.conv_id IS NOT DISTINCT FROM x.conv_id LEFT JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = 0
"""


SQL = _sql()
