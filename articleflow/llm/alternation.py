"""Wagner-Fischer alignment of role codes to alternating role strings.

A conversation is a string of codes, one for each turn: ``s``, ``u``, ``a``
(system, user, assistant), ``o`` (any other role), in upper case where the turn
is truncated, and ``x`` where it must be deleted.  Legal role strings are
``(s?(ua)+)?``.  States between turns: 0 nothing yet, 1 after the system turn,
2 after a user turn, 3 after an assistant turn.

Costs: keep 0, rerole to user or assistant 2, delete 3, insert 2; a truncated
turn that is not deleted adds 1.

The last j roles of any legal string alternate, so one table over (last r turns,
last j roles) serves every feasible length of the target.  Its rows are cut to
Ukkonen's band: with an incumbent of cost X, a cell with more turns than roles
left costs 3 for each, one with more roles than turns 2 for each.  Turns that
must go are no rows of the table.  All targets of least cost are traced back,
and the audit (edit initials) that comes first in ASCII order wins; in a trace
the order D, I, K, R is the order of the letters, so each step takes the first
edit that keeps the cost.

``align`` solves a whole conversation (from state 0 to an accepting state) or a
segment of a long one (from a given state, with the least cost ``goal[q]`` of
everything after the segment for each state q it may end in).  Inserts at the
border of two segments belong to the later one, so a conversation has one
split into segments' audits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 40
#: How much dearer the least path between two states of a segment may be than
#: the greedy one: one more insert and rerole to swap the last role, and one
#: delete of a system turn that state 0 would keep.
SLACK = 8


def _needs(state: int) -> str:
    return "a" if state == USER else "u"


def _after(state: int, role: str) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role]


def greedy(codes: str, state: int) -> tuple[int, int]:
    """Cost and last state of keeping or reroling every turn (no x in codes)."""
    cost = 0
    for c in codes:
        cost += TRUNCATED * c.isupper()
        c = c.lower()
        if c == "s" and state == START:
            state = SYSTEM
            continue
        need = _needs(state)
        cost += KEEP if c == need else REROLE
        state = _after(state, need)
    return cost, state


class Band:
    """Least cost of aligning the last r turns with the last j roles of an
    alternating string that ends in state ``end``."""

    def __init__(self, codes: str, end: int, bound: int, inserts: bool):
        n = len(codes)
        self.below, above = min(n, bound // DELETE), bound // INSERT
        d = np.arange(self.below + above + 1)
        self.rows = np.full((n + 1, len(d) + 1), FAR, np.int64)      # one column beyond the band stays FAR
        j = d - self.below
        self.rows[0, :-1] = np.where(j == 0, 0, np.where((j > 0) & inserts, INSERT * j, FAR))
        for r in range(1, n + 1):
            c = codes[n - r]
            j = d + (r - self.below)
            fits = {"u": (j % 2 == 0) == (end == ASSISTANT), "a": (j % 2 == 1) == (end == ASSISTANT)}.get(c.lower())
            change = TRUNCATED * c.isupper() + (REROLE if fits is None else np.where(fits, KEEP, REROLE))
            last = self.rows[r - 1]
            best = np.minimum(np.where(j > 0, last[:-1] + change, FAR), last[1:] + DELETE)
            best[j < 0] = FAR
            self.rows[r, :-1] = np.minimum(np.minimum.accumulate(best - INSERT * d) + INSERT * d, FAR)

    def at(self, r: int, j: int) -> int:
        k = j - r + self.below
        return int(self.rows[r, k]) if 0 <= k < self.rows.shape[1] - 1 else FAR

    def lengths(self, r: int, start: int, end: int, zero: bool) -> list[int]:
        """Feasible numbers of roles from ``start`` to ``end`` for the last r turns."""
        odd = (_needs(start) == "u") != (end == ASSISTANT)
        first = max(0, r - self.below)
        found = (np.flatnonzero(self.rows[r, :-1] < FAR) + r - self.below).tolist()
        return [j for j in found if j >= first and j % 2 == odd and (j or zero)]


def _trace(band: Band, codes: str, r: int, j: int, state: int) -> str:
    """The first audit in ASCII order of a least alignment of the last r turns
    with the last j roles; ``codes`` may hold x."""
    out, at = [], len(codes)
    left = 0
    while left < r or (at and codes[at - 1] == "x"):      # where the last r turns begin, x before them included
        at -= 1
        left += codes[at] != "x"
    while at < len(codes) or j:
        c = codes[at] if at < len(codes) else ""
        if c == "x":
            out.append("D")
            at += 1
            continue
        here = band.at(r, j)
        if r and band.at(r - 1, j) + DELETE == here:
            out.append("D")
            r, at = r - 1, at + 1
        elif j and band.at(r, j - 1) + INSERT == here:
            out.append("I")
            j, state = j - 1, _after(state, _needs(state))
        else:
            need = _needs(state)
            out.append("K" if c.lower() == need else "R")
            r, j, at, state = r - 1, j - 1, at + 1, _after(state, need)
    return "".join(out)


def _targets(codes: str, entry: int, goal: tuple, bound: int, inserts: bool):
    """(cost with goal, end state, number of turns left after a kept system turn
    or None, roles, band) of every feasible target."""
    n = len(codes)
    for end in (USER, ASSISTANT):
        if goal[end] >= FAR:
            continue
        band = Band(codes, end, bound, inserts)
        starts = [(None, n, 0, entry)]
        if entry == START:
            starts += [(n - i - 1, n - i - 1, DELETE * i + TRUNCATED * c.isupper(), SYSTEM)
                       for i, c in enumerate(codes) if c in "sS" and DELETE * i <= bound]
        for kept, r, paid, state in starts:
            for j in band.lengths(r, state, end, zero=state == end):
                yield paid + band.at(r, j) + goal[end], end, kept, j, band
    for state in (START, SYSTEM):                     # targets that end before any user turn
        if goal[state] >= FAR:
            continue
        if state == entry:
            yield DELETE * n + goal[state], state, None, 0, None
        elif (entry, state) == (START, SYSTEM):
            for i, c in enumerate(codes):
                if c in "sS":
                    yield DELETE * (n - 1) + TRUNCATED * c.isupper() + goal[state], state, n - i - 1, 0, None


def _audit(codes: str, entry: int, kept: int | None, roles: int, band: Band | None) -> str:
    own = len(codes) - codes.count("x")
    if kept is None:
        return _trace(band, codes, own, roles, entry) if band else "D" * len(codes)
    head, left, at = [], own, 0
    while left > kept:
        left -= codes[at] != "x"
        head.append("D" if codes[at] == "x" or left > kept else "K")
        at += 1
    tail = codes[at:]
    return "".join(head) + (_trace(band, tail, kept, roles, SYSTEM) if band else "D" * len(tail))


WHOLE = (0, FAR, FAR, 0)


@lru_cache(maxsize=1 << 14)
def align(codes: str, entry: int = START, goal: tuple = WHOLE, last: bool = True) -> tuple[int, str, int]:
    """(cost, audit, end state) of the cheapest edits; of equal ones the first
    audit in ASCII order.  The cost is that of the segment alone."""
    own = codes.replace("x", "")
    if last:
        cost, state = greedy(own, entry)
        cost += INSERT * {SYSTEM: 2, USER: 1}.get(state, 0)
        bound = min(cost, DELETE * len(own)) if entry == START else cost
    else:
        bound = max(greedy(own, p)[0] for p in (START, USER, ASSISTANT)) + SLACK
    best, audits = FAR, []
    for target in _targets(own, entry, goal, bound, last):
        if target[0] < best:
            best, audits = target[0], []
        if target[0] == best:
            audits.append(target[1:])
    if best >= FAR:
        return FAR, "", entry
    audit, end = min((_audit(codes, entry, kept, roles, band), end) for end, kept, roles, band in audits)
    return best - goal[end] + DELETE * (len(codes) - len(own)), audit, end


def costs(codes: str) -> np.ndarray:
    """Least cost of a segment between every two states (4 x 4), inserts after
    its last turn left out."""
    out = np.full((4, 4), FAR, np.int64)
    for p in range(4):
        for q in range(4):
            out[p, q] = align(codes, p, tuple(0 if k == q else FAR for k in range(4)), False)[0]
    return out


def apply(audit: str, roles: list[str], texts: list[str], codes: str, entry: int = START) -> list[tuple[str, str]]:
    """The repaired turns.  ``roles`` and ``texts`` belong to the turns that are
    not x; inserted turns have an empty text."""
    out, at, own, state = [], 0, 0, entry
    name = {"u": "user", "a": "assistant"}
    for edit in audit:
        if edit == "I":
            need = _needs(state)
            out.append((name[need], ""))
            state = _after(state, need)
            continue
        c = codes[at].lower()
        at += 1
        if edit != "D":
            role = c if edit == "K" else _needs(state)
            out.append((roles[own] if edit == "K" else name[role], texts[own]))
            state = _after(state, role)
        own += c != "x"
    return out
