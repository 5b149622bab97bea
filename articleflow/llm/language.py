"""Language identification of whole texts, span by span.

Method: the script of a word (Unicode ranges) narrows the languages that it may
belong to; each candidate scores the word by hashed character n-grams; Viterbi
with a penalty for each switch labels the words, so that a mixed text falls into
spans of one language; the language with most letters is the text's.

* A word is a run of letters (and other numerals, which score nothing by
  themselves).  Its features are the n-grams of 1 to ORDER characters of the
  lower-cased word between two marks.
* Counts of n-grams and of letters by script are summed over all learning
  documents, for each language, by Spark.  The hashed table has 2**bits rows and
  a column for each language; ``bits`` shrinks with the number of languages, so
  the table has at most CELLS cells whatever the corpus, which bounds the
  broadcast.
* A word's score in a language is the mean over the orders of the summed log
  shares of its n-grams, not more than CAP below the best language's.  A
  language whose learning letters are to less than MIN_SHARE in the word's
  script is no candidate; a word of a script that no language has says nothing.
* Viterbi runs only where it can matter: if no run of words gains more than
  half the penalty in another language, the text's best single language is the
  best labelling.  (r other runs within it gain at most r/2 penalties and cost
  at least r; r >= 2 runs without it gain at most r/2 and cost r - 1; one run
  without it is another single language.)
* The score is the share of the text's letters in spans of the predicted
  language times the logistic of the whole text's margin to the next language.

Defined cases: a null text, a text without letter, and any text if nothing was
learned give ``und`` with score 0 and no span; ties go to the smaller language
name; rows with a null doc_id teach nothing; a doc_id that repeats is judged
(and learned) row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, table

ORDER = 4
BITS, CELLS = 16, 1 << 24
#: Penalty of a switch, greatest loss of a word, least share of a script, added count.
SWITCH, CAP, MIN_SHARE, PRIOR = 12.0, 8.0, 0.01, 0.5
UNKNOWN = "und"
#: Words whose scores a task remembers (cells), and characters of text that it takes at a time.
REMEMBER, SLICE = 1 << 23, 1 << 20
#: Words of a piece of a text, and cells of the pieces that are labelled together.
PIECE, STEPS = 64, 1 << 22
#: Languages that a task counts at a time.
COUNTED = 32

#: First code point of each range of scripts, and the script
#: ("" are symbols and rare scripts, which count as one).
SCRIPTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
           (0x0700, ""), (0x0750, "Arabic"), (0x0780, ""), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
           (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
           (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
           (0x13A0, ""), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""),
           (0x2C60, "Latin"), (0x2C80, ""), (0x2DE0, "Cyrillic"), (0x2E00, ""), (0x3040, "Kana"), (0x3100, ""), (0x3130, "Hangul"), (0x3190, ""),
           (0x31F0, "Kana"), (0x3200, ""), (0x3400, "Han"), (0xA000, ""), (0xA640, "Cyrillic"), (0xA6A0, ""), (0xA720, "Latin"), (0xA800, ""),
           (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, ""), (0xFB50, "Arabic"), (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, "Latin"),
           (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, ""), (0x20000, "Han"), (0x30000, "Han"), (0x40000, "")]
_NAMES = sorted({s for _, s in SCRIPTS})
_FROM = np.array([c for c, _ in SCRIPTS])
_SCRIPT = np.array([_NAMES.index(s) for _, s in SCRIPTS])

_WORD = re.compile(r"[^\W\d_]+")


def scripts_of(words: list[str]) -> np.ndarray:
    """Number of the script of each word's first character."""
    return _SCRIPT[np.searchsorted(_FROM, [ord(w[0]) for w in words], side="right") - 1]


def grams(words: list[str], bits: int, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, order, bucket) of every n-gram of the words, word by word
    within an order."""
    text = "".join(f"\x02{w.lower()}\x03" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.cumsum(codes == 2) - 1
    rows, orders, buckets, h = [], [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, order + 1):
        h = h[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:] + np.uint64(1)
        inside = word[:len(h)] == word[n - 1:]
        if n == 1:
            inside = codes > 3                      # the marks alone say nothing
        rows.append(word[:len(h)][inside])
        orders.append(np.full(len(rows[-1]), n, np.int64))
        buckets.append((mix64(h[inside] + np.uint64(n << 56)) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(orders), np.concatenate(buckets)


class Model:
    """Languages, log shares of the buckets (2**bits rows, a column for each
    language), and which language is a candidate in which script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, bits: int):
        self.langs, self.bits = langs, bits
        counts = counts.astype(np.float32)
        size = counts.sum(axis=0, dtype=np.float64) + PRIOR * len(counts)
        self.table = np.log((counts + np.float32(PRIOR)) / size.astype(np.float32)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.candidate = share >= MIN_SHARE                     # scripts x languages

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log score of each word in each language, best 0, least -CAP."""
        row, _, bucket = grams(words, self.bits)
        order = np.argsort(row, kind="stable")
        row, values = row[order], self.table[bucket[order]]
        out = np.zeros((len(words), len(self.langs)), np.float32)
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[first]] = np.add.reduceat(values, first, axis=0) / ORDER
        able = self.candidate[scripts_of(words)]
        known = able.any(axis=1)
        out = np.where(able, out, -np.inf)
        out[~known] = 0
        return np.maximum(out - out.max(axis=1, keepdims=True), -CAP)


def viterbi(texts: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """For each text (scores of its words) the labels with the greatest sum of
    scores less ``switch`` for each change of label.

    Texts are cut into pieces of PIECE words (padded with words that say
    nothing), and all pieces take their steps together: the best sums from each
    label before a piece to each label at its end.  The pieces of a text are
    then chained, and traced back together."""
    k = texts[0].shape[1] if texts else 0
    pieces = [-(-len(t) // PIECE) for t in texts]
    s = np.zeros((sum(pieces), PIECE, k), np.float32)
    for n, (t, first) in enumerate(zip(texts, np.cumsum([0, *pieces]).tolist())):
        s[first:first + pieces[n]].reshape(-1, k)[:len(t)] = t
    room = max(1, STEPS // (PIECE * k * k)) if k else 1
    sums, backs = [], []
    for lo in range(0, len(s), room):
        part = s[lo:lo + room]
        best = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(len(part), axis=0)       # piece, label before, label now
        back = np.empty((PIECE, len(part), k, k), np.int16)
        for i in range(PIECE):
            top = best.argmax(axis=2)[..., None]
            moved = np.take_along_axis(best, top, 2) - switch
            stay = best >= moved
            back[i] = np.where(stay, np.arange(k), top)
            best = np.where(stay, best, moved) + part[:, i, None, :]
        sums.append(best)
        backs.append(back)
    sums = [m for part in sums for m in part]
    entry, leave, at = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64), 0
    for n in pieces:
        value, came = np.zeros(k), []
        for m in sums[at:at + n]:
            total = value[:, None] + m
            came.append(total.argmax(axis=0))
            value = total.max(axis=0)
        label = int(value.argmax())
        for i in range(at + n - 1, at - 1, -1):
            leave[i], label = label, int(came[i - at][label])
            entry[i] = label
        at += n
    labels, at = np.empty((len(s), PIECE), np.int64), 0
    for back in backs:
        rows, now = np.arange(back.shape[1]), leave[at:at + back.shape[1]]
        own = entry[at:at + back.shape[1]]
        for i in range(PIECE - 1, -1, -1):
            labels[at:at + len(rows), i] = now
            now = back[i, rows, own, now]
        at += len(rows)
    flat, out, at = labels.reshape(-1), [], 0
    for t, n in zip(texts, pieces):
        out.append(flat[at:at + len(t)])
        at += n * PIECE
    return out


def one_language(scores: np.ndarray, switch: float = SWITCH) -> int | None:
    """The single best language, if no other labelling can beat it."""
    top = int(scores.sum(axis=0, dtype=np.float64).argmax())
    run = np.cumsum(scores.astype(np.float64) - scores[:, top:top + 1], axis=0)
    low = np.minimum(np.minimum.accumulate(run, axis=0), 0)
    low = np.vstack([np.zeros((1, run.shape[1])), low[:-1]])
    return top if (run - low).max() <= switch / 2 else None


def _learn(docs: DataFrame, bits: int) -> DataFrame:
    """(lang, at, n): counts of buckets, then of letters by script (at from 2**bits)."""
    size = (1 << bits) + len(_NAMES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def count() -> None:
            for lang, found in words.items():
                names, n = list(found), np.fromiter(found.values(), np.float64, len(found))
                row, _, bucket = grams(names, bits)
                total = held.setdefault(lang, np.zeros(size))
                total += np.bincount(bucket, weights=n[row], minlength=size)
                letters = np.fromiter(map(len, names), np.int64, len(names))
                total += np.bincount(scripts_of(names) + (1 << bits), weights=n * letters, minlength=size)
            words.clear()

        def emit() -> Iterator[pd.DataFrame]:
            for lang, total in held.items():
                at = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "at": at, "n": total[at].astype(np.int64)})
            held.clear()
        for b in batches:
            taken = 0
            for lang, text in zip(b["lang"], b["text"]):
                found = _WORD.findall(text) if text else []
                if found:
                    words.setdefault(lang, Counter()).update(found)
                    taken += len(text)
                if taken >= 8 * SLICE or len(words) >= COUNTED:
                    count()
                    taken = 0
                if len(held) >= COUNTED:
                    yield from emit()
            count()
        yield from emit()
    return docs.select("lang", "text").mapInPandas(run, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, bits: int = BITS, cells: int = CELLS) -> Model:
    """Model of the languages in column ``lang`` (nulls teach nothing) from all
    rows of ``docs`` (lang, text).  One row for each language reaches the
    driver, its counts packed; the table has at most ``cells`` cells."""
    docs = docs.where("lang is not null").select(F.col("lang").cast("string"), "text")
    most = docs.select("lang").distinct().count()
    while bits > 8 and most << bits > cells:
        bits -= 1
    if most << bits > cells:
        raise ValueError(f"{most} languages do not fit into a table of {cells} cells")
    size = (1 << bits) + len(_NAMES)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, np.int64)
        total[pdf["at"]] = pdf["n"]
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [total.tobytes()]})
    rows = _learn(docs, bits).groupBy("lang").applyInPandas(pack, "lang string, counts binary").collect()
    found = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in rows}
    langs = sorted(found)
    both = np.stack([found[x] for x in langs], axis=1) if langs else np.zeros((size, 0))
    return Model(langs, both[:1 << bits], both[1 << bits:], bits)


class Words(dict):
    """Numbers words as they are asked for; ``new`` lists those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class Labeler:
    """Labels texts; remembers the scores of words it has met."""

    def __init__(self, model: Model, switch: float = SWITCH):
        self.model, self.switch = model, switch
        self.room = max(1, REMEMBER // max(1, len(model.langs)))
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        self.scores, self.letters = np.empty((0, len(self.model.langs)), np.float32), np.empty(0, np.int64)

    def _learn_words(self) -> None:
        new, known = self.words.new, len(self.words) - len(self.words.new)
        if len(self.words) > len(self.scores):                  # room for as many again
            self.scores = np.concatenate([self.scores[:known], np.empty((len(self.words), self.scores.shape[1]), np.float32)])
            self.letters = np.concatenate([self.letters[:known], np.empty(len(self.words), np.int64)])
        self.scores[known:len(self.words)] = self.model.word_scores(new)
        self.letters[known:len(self.words)] = [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new]
        self.words.new = []

    def labels(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        """(language, score, spans) of each text."""
        if not self.model.langs:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        if len(self.words) > self.room:
            self.forget()
        found = [_WORD.findall(t) if t else [] for t in texts]
        at = [np.fromiter(map(self.words.__getitem__, w), np.int64, len(w)) for w in found]
        if self.words.new:
            self._learn_words()
        scores = [self.scores[a] for a in at]
        one = [one_language(s, self.switch) if len(s) else 0 for s in scores]
        mixed = iter(viterbi([s for s, o in zip(scores, one) if o is None], self.switch))
        return [self._label(t, w, self.letters[a], s, next(mixed) if o is None else np.full(len(a), o))
                for t, w, a, s, o in zip(texts, found, at, scores, one)]

    def _label(self, text: str | None, words: list[str], letters: np.ndarray, scores: np.ndarray, own: np.ndarray) -> tuple[str, float, list[dict]]:
        if not letters.sum():
            return UNKNOWN, 0.0, []
        names = self.model.langs
        share = np.bincount(own, weights=letters, minlength=len(names))
        top = int(share.argmax())
        total = scores.sum(axis=0, dtype=np.float64)
        margin = total[top] - np.delete(total, top).max(initial=-np.inf) if len(names) > 1 else np.inf
        first = np.flatnonzero(np.diff(own, prepend=-1))
        if len(first) == 1:
            begin = text.index(words[0])
            spans = [{"start": begin, "end": text.rindex(words[-1]) + len(words[-1]), "lang": names[top]}]
        else:
            place = [m.span() for m in _WORD.finditer(text)]
            last = np.append(first[1:], len(own)) - 1
            spans = [{"start": place[i][0], "end": place[j][1], "lang": names[own[i]]} for i, j in zip(first.tolist(), last.tolist())]
        return names[top], float(share[top] / share.sum() / (1 + np.exp(-np.clip(margin, -35, 35)))), spans


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row; spans are ranges of
    characters (end exclusive) and their languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeler = Labeler(shared.value, switch)
        for b in batches:
            texts, out, size = b["text"].tolist(), [], 0
            start = 0
            for stop, text in enumerate(texts, 1):
                size += len(text) if text else 0
                if size >= SLICE or stop == len(texts):
                    out += labeler.labels(texts[start:stop])
                    start, size = stop, 0
            yield pd.DataFrame({"doc_id": b["doc_id"], "none": b["none"], "lang_pred": [x for x, _, _ in out], "score": [x for _, x, _ in out],
                                "spans": [x for _, _, x in out]})
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("none"), "text")
    kind = "doc_id long, none boolean, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
    return rows.mapInPandas(run, kind).select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "lang_pred", "score", "spans")


def held_out(doc_id: Column) -> Column:
    """True for the rows whose language is never learned (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op13_language(spark, sf_dir):
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, learn(docs.where(~held_out(F.col("doc_id")))))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
