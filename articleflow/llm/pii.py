"""Personal data: e-mail addresses, IP addresses, card and phone numbers.

Method: weak supervision.  Eight labelers of three sorts vote on candidate
spans, expectation-maximisation estimates how reliable each labeler is, and the
resulting probabilities train a final span classifier, which decides.

Base spans (fixed patterns, leftmost and without overlaps per kind, failed
checks dropped without a retry) always stay.  Wider patterns give further
candidates: written-out addresses (``name (at) host (dot) org``), IPv6, card
numbers with other separators, phone numbers without a country code.  The
classifier adds those it gives at least ``ADD``, if they pass the kind's own
check and overlap no base span of the kind.

Labelers, by sort:

* regular expressions: the base pattern with its check (for); the kind's own
  check (for or against); a regular grouping (for or against); neighbours that
  end the span (for) or run on (against);
* gazetteers: known top-level domains, card issuers, calling codes, routable
  addresses (for or against); placeholders and reserved values (against);
* context words to the left: of the kind (for); of other numbers, such as
  orders, versions, parts (against).

Matches of the patterns that fail their check are candidates too, and every
candidate has a corrupted twin in its place (a check digit changed, an octet
over 255, an unknown domain, digits cut off) and without the words around it, which
is known to be none.  So the labelers meet cases of both classes, and the twins'
class is fixed in the estimation.  It starts from a veto: a candidate that any
labeler votes against is taken for none at first, others go by the majority.
Reliabilities have a prior (``TRUST`` votes in a labeler's favour), which rare
labelers keep.

A candidate is described by BITS bits (votes and shape), so the whole corpus
is summed up as a count for each distinct description: at most 2**BITS for each
kind and class, one combined aggregate.  Estimation and training work on these
counts, which come from all documents, and the weights go back to the tasks.

Defined cases: null and empty texts have no spans; rows that repeat a doc_id
are searched one by one; without any candidate nothing is added; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

KINDS = ("email", "ip", "card", "phone")
ADD = 0.8
ROUNDS = 50

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Wider patterns for further candidates.
_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[{<] ?at ?[)\]}>] ?[A-Za-z0-9-]{1,63}(?: ?(?:[(\[{<] ?dot ?[)\]}>]|\.) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])")
_CARD2 = re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4}){2}[ ./_-]{1,2}[0-9]{1,7}(?![0-9])")
_PHONE2 = re.compile(r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[ .-])?\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])")
# Gazetteers and context words.
_TOP_LEVEL = frozenset("com org net edu gov mil int info io biz name pro app dev ai me tv cc "
                       "ar at au be br ca ch cl cn co cz de dk ee es eu fi fr gr hk hu ie il in it jp kr lt lu lv mx nl no nz pl pt ro ru se sg si sk tr tw ua uk us za".split())
_ISSUERS = [(r"4", (13, 16, 19)), (r"5[1-5]|2[2-7]", (16,)), (r"3[47]", (15,)), (r"3(?:0[0-5]|[68])", (14, 16)), (r"6(?:011|5|4[4-9])", (16, 19)),
            (r"35", (16,)), (r"62", (16, 17, 18, 19)), (r"5[06-8]|6[0-9]", (12, 13, 14, 15, 16, 17, 18, 19))]
_ISSUED = [(re.compile(head), sizes) for head, sizes in _ISSUERS]
_CALLING = re.compile(r"(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[23589][0-9]{2})")
_AREA = re.compile(r"\(?[2-9][0-9]{2}")
_CONTEXT = {
    "email": re.compile(r"mail|contact|write|reach|correo|courriel|kontakt|envoy|escri", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|client|adresse|direcc", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|\btel|call|mobile|fax|cell|anruf|appel|llam|ring|sms", re.I),
}
_AGAINST = re.compile(r"version|release|build|order|invoice|serial|isbn|\bid\b|part no|part number|sku|model|ticket|tracking|bestell|commande|pedido|\bno\.|#", re.I)
_PLACEHOLDER = re.compile(r"example|invalid|localhost|your|name\W*(?:\(|\[)at|^(?:0|127|255)\.|^1\.2\.3\.4$|(?:^|[^0-9])([0-9])(?:[ -]?\1){7,}|12345678", re.I)
_FORM = {
    "email": re.compile(r"(?i)[a-z0-9](?:[a-z0-9_%+-]|[.](?![.]))*\W*(?:@|at\b)\W*[a-z0-9].*[a-z]{2}[)\]}>]?"),
    "ip": re.compile(r"(?:(?:0|[1-9][0-9]{0,2})(?:\.(?!$)|$)){4}|[0-9A-Fa-f:]+"),
    "card": re.compile(r"[0-9]{12,19}|[0-9]{4}([ ./_-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{4,5}"),
    "phone": re.compile(r"(?:(?:\+|00)[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]{1,2}[0-9]{2,4}){2,4}|\+[0-9]{9,15}"),
}
#: The labelers, a bit each: the votes that it casts where it holds and where
#: not (1 for, 2 against, 0 none).
LABELERS = (("base", 1, 0), ("check", 1, 2), ("form", 1, 2), ("ends", 1, 2), ("known", 1, 2), ("placeholder", 2, 0), ("context", 1, 0), ("against", 2, 0))
BITS = 13
#: Votes that a labeler has in its favour before any is counted.
TRUST = 4.0


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def passes(kind: str, s: str) -> bool:
    """The kind's own check of a span's text."""
    if kind == "ip":
        return ":" in s or all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        return 12 <= len(d := _digits(s)) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_digits(s)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Linear form of the e-mail pattern: each match has one @, the longest
    run of local characters before it, and the longest domain after it."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def base_spans(text: str | None, failed: list | None = None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base spans, by start, then kind.
    ``failed`` takes the matches of about the right length that fail the check."""
    out = []
    if text and "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if text and _DIGIT.search(text):
        for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            if k == 3 and "+" not in text:
                continue
            for m in pattern.finditer(text):
                if passes(KINDS[k], m.group()):
                    out.append((m.start(), k, m.end()))
                elif failed is not None and (k != 2 or m.end() - m.start() >= 12):
                    failed.append((m.start(), k, m.end()))
    return sorted(out)


def wider_spans(text: str | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap no base span of their kind and pass its check."""
    out = []
    if not text:
        return out
    found = [(0, _AT)] if "at" in text or "AT" in text else []
    if _DIGIT.search(text):
        found += [(1, _IP6)] * (":" in text) + [(2, _CARD2), (3, _PHONE2)]
    for k, pattern in found:
        taken = [(a, b) for a, kk, b in base if kk == k]
        starts = [a for a, _ in taken]
        for m in pattern.finditer(text):
            at = bisect_left(starts, m.end())
            if (at == 0 or taken[at - 1][1] <= m.start()) and passes(KINDS[k], m.group()):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def _known(kind: str, s: str) -> bool:
    """Whether a gazetteer knows the span's issuer, domain, code or network."""
    if kind == "email":
        return re.split(r"[^A-Za-z0-9-]+", s.rstrip(" )]}>"))[-1].lower() in _TOP_LEVEL
    if kind == "ip":
        return s.startswith(("2", "3", "fe80", "fd", "fc")) if ":" in s else 0 < int(s.split(".")[0] or 0) < 240
    if kind == "card":
        digits = _digits(s)
        return any(head.match(digits) and len(digits) in sizes for head, sizes in _ISSUED)
    return bool((_CALLING if s[0] == "+" or s.startswith("00") else _AREA).match(s))


def corrupted(kind: str, s: str) -> str:
    """The span's text spoilt in one place, so that it is none of its kind."""
    if kind == "email":
        return re.sub(r"[A-Za-z0-9-]+(?=[^A-Za-z0-9-]*$)", "zzq", s)
    if kind == "ip":
        parts = s.split(".")
        return s.replace(":", ".", 1) if ":" in s else ".".join([*parts[:2], str(int(parts[2] or 0) + 256), *parts[3:]])
    if kind == "card":
        return s[:-1] + str((int(s[-1]) + 1) % 10)
    return s[:max(4, len(s) - 6)]


def describe(s: str, left: str, right: str, kind: str, strict: bool) -> int:
    """The bits of a candidate: whether each labeler holds, and the shape."""
    valid = passes(kind, s) if kind != "email" else bool(re.search(r"[.]|dot", s.split("@")[-1][1:], re.I))
    ends = not (left and (left[-1].isalnum() or left[-1] in "._-+/@")) and not (right and (right[0].isalnum() or right[0] in "_@/" or right[:2].strip(".-").isdigit()))
    votes = (strict, valid, bool(_FORM[kind].fullmatch(s)), ends, _known(kind, s), bool(_PLACEHOLDER.search(s)),
             bool(_CONTEXT[kind].search(left)), bool(_AGAINST.search(left)))
    shape = (bool(re.search(r"[ ()\[\]]", s)), bool(re.search(r"[-_/]", s)), len(s) > 16, len(s) > 24, s[:1].isdigit())
    return sum(on << n for n, on in enumerate(votes + shape))


def _around(text: str, a: int, b: int) -> tuple[str, str]:
    return text[max(0, a - 40):a], text[b:b + 12]


def descriptions(docs: DataFrame) -> DataFrame:
    """(kind, bits, none, n): how many candidates of the corpus have each
    description, and how many of their corrupted twins (none)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: dict[tuple[int, int, bool], int] = {}
            for t in b["text"]:
                failed: list = []
                base = base_spans(t, failed)
                for (a, k, e), strict in [(x, True) for x in base] + [(x, False) for x in wider_spans(t, base) + failed]:
                    s, (left, right) = t[a:e], _around(t, a, e)
                    for key in ((k, describe(s, left, right, KINDS[k], strict), False),
                                (k, describe(corrupted(KINDS[k], s), left[-1:], right, KINDS[k], False), True)):
                        out[key] = out.get(key, 0) + 1
            yield pd.DataFrame([(*key, n) for key, n in out.items()], columns=["kind", "bits", "none", "n"])
    rows = docs.select("text").mapInPandas(run, "kind int, bits int, none boolean, n long")
    return rows.groupBy("kind", "bits", "none").agg(F.sum("n").alias("n"))


def votes_of(bits: np.ndarray) -> np.ndarray:
    """The labelers' votes, a row for each description."""
    return np.stack([np.where(bits >> k & 1, on, off) for k, (_, on, off) in enumerate(LABELERS)], axis=1)


def reliabilities(votes: np.ndarray, n: np.ndarray, none: np.ndarray | None = None, veto: bool = False, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation (Dawid and Skene, 1979) over vote patterns with
    their counts: P(vote | class) of each labeler, and the probability of class
    1 of each pattern (0 where ``none`` is known, from the start).  Else it starts
    from the majority, with ``veto`` at 0.01 where any labeler is against; each
    labeler has one vote of each sort and TRUST right ones beforehand."""
    known = np.zeros(len(n), bool) if none is None else none
    p = np.clip(0.5 + 0.2 * ((votes == 1).sum(1) - (votes == 2).sum(1)), 0.05, 0.95)
    p = np.where(known, 0.0, np.where(veto & (votes == 2).any(1), 0.01, p))
    table_ = np.zeros((2, votes.shape[1], 3))
    prior_votes = np.ones((2, 1, 3))
    prior_votes[1, :, 1] += TRUST
    prior_votes[0, :, 2] += TRUST
    prior_votes[:, :, 0] += TRUST / 2
    casts = np.stack([(votes == v).any(axis=0) for v in range(3)], axis=1)          # sorts of votes that a labeler casts
    for _ in range(rounds):
        weight = np.stack([(1 - p) * n, p * n])
        for v in range(3):
            table_[:, :, v] = weight @ (votes == v)
        table_ = (table_ + prior_votes) * casts
        table_ /= table_.sum(2, keepdims=True)
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        like = np.log(prior)[:, None] + sum(np.log(table_[:, j, votes[:, j]]) for j in range(votes.shape[1]))
        p = np.where(known, 0.0, 1 / (1 + np.exp(np.clip(like[0] - like[1], -35, 35))))
    return table_, p


def train(counts: pd.DataFrame, steps: int = 40, ridge: float = 1e-5) -> dict[int, np.ndarray]:
    """Weights of the span classifier of each kind: logistic regression on the
    description bits (labelers included) towards the labelers' consensus, by
    Newton's method."""
    out = {}
    for kind, part in counts.sort_values(["kind", "bits", "none"]).groupby("kind"):
        bits, n = part["bits"].to_numpy(), part["n"].to_numpy(float)
        _, p = reliabilities(votes_of(bits), n, part["none"].to_numpy(bool), veto=True)
        x = np.concatenate([(bits[:, None] >> np.arange(BITS)) & 1, np.ones((len(bits), 1))], 1).astype(float)
        # a description counts by the root of its number, so that the rare ones have a say
        w, n = np.zeros(BITS + 1), np.sqrt(n) / np.sqrt(n).sum()
        for _ in range(steps):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
            slope = x.T @ (n * (q - p)) + ridge * w
            w -= np.linalg.solve(x.T @ (x * (n * q * (1 - q))[:, None]) + ridge * np.eye(BITS + 1), slope)
        out[int(kind)] = w
    return out


def probability(bits: int, w: np.ndarray) -> float:
    x = np.append((bits >> np.arange(BITS)) & 1, 1)
    return float(1 / (1 + np.exp(-x @ w)))


def find_personal_data(docs: DataFrame, add: float = ADD) -> DataFrame:
    """(doc_id, base, spans) of every row of ``docs`` (doc_id, text): arrays of
    (kind, start, end) in code points, by start, then kind."""
    weights = train(descriptions(docs).toPandas())

    def named(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[int, int], float] = {}
        for b in batches:
            base, spans = [], []
            for t in b["text"]:
                own, more = base_spans(t), []
                for a, k, e in wider_spans(t, own):
                    key = k, describe(t[a:e], *_around(t, a, e), KINDS[k], False)
                    if key not in known:
                        known[key] = probability(key[1], weights[k]) if k in weights else 0.0
                    if known[key] >= add:
                        more.append((a, k, e))
                base.append(named(own))
                spans.append(named(sorted(own + more)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "base": base, "spans": spans})
    kind = "array<struct<kind:string,start:int,end:int>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, f"doc_id long, base {kind}, spans {kind}")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def op9_pii(spark, sf_dir):
    """doc_id, counts of base spans, base_sha256, spans of every document."""
    out = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))
