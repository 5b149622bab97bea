"""Token counts.

Method: whole-token shortcut.  Offline it is proved which vocabulary strings
encode alone as one token; pre-tokens that are such strings count directly,
and only the rest is merged by the tokenizer library.

sentencepiece BPE models with the identity normaliser: blanks become U+2581,
one is put in front, and merges only ever build vocabulary pieces.  When no
piece has U+2581 after another character (``check_model`` verifies it with the
other assumptions), no merge crosses the place before a run of blanks, so a
text's tokens are those of its pre-tokens (a run of blanks and the characters
up to the next one) taken by themselves, and line feeds and other characters
need no special case.

Defined cases: null and empty texts have no tokens; rows that repeat a doc_id
are counted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

LIMIT = 4096
#: Pre-tokens that a worker remembers, and the longest of them; a memo only.
MEMO, MEMO_CHARS = 400_000, 32
_SPACE = "▁"
_PRE = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def _processor(model: bytes):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Raise unless the model meets the assumptions above."""
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    norm, pieces = proto.normalizer_spec, [p.piece for p in proto.pieces if p.type in (1, 4, 5)]
    if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix \
            or not norm.escape_whitespaces or any(p.type == 4 for p in proto.pieces) \
            or any(_SPACE in p.lstrip(_SPACE) for p in pieces):
        raise ValueError("merges of this model may cross pre-tokens")


def whole_tokens(model: bytes) -> list[str]:
    """Pre-tokens (one blank and a word) that the library encodes as one token."""
    sp = _processor(model)
    words = [p[1:] for p in map(sp.id_to_piece, range(sp.get_piece_size())) if p.startswith(_SPACE) and len(p) > 1 and _SPACE not in p[1:]]
    return [w for w, ids in zip(words, sp.encode(words, num_threads=1)) if len(ids) == 1]


class PreTokens(dict):
    """Number of tokens of a word after one blank; words that are no whole
    token are merged by the library, and short ones remembered."""

    def __init__(self, model: bytes, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.sp, self.room = _processor(model), MEMO

    def __missing__(self, word: str) -> int:
        n = len(self.sp.encode(word, num_threads=1)) or 1   # the blank alone is a token
        if self.room > 0 and len(word) <= MEMO_CHARS:
            self.room -= 1
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if _SPACE in text:
            text = text.replace(_SPACE, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return sum(map(self.__getitem__, text.split(" ")))
        return sum(self[seg[1:]] for seg in _PRE.findall(" " + text))


@lru_cache(maxsize=2)
def _counter(model: bytes, whole: tuple[str, ...]) -> PreTokens:
    return PreTokens(model, list(whole))


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text)."""
    with open(model_path, "rb") as f:
        model = f.read()
    check_model(model)
    shared = docs.sparkSession.sparkContext.broadcast((model, tuple(whole_tokens(model))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(*shared.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": [len(t.encode()) if t else 0 for t in b["text"]],
                                "n_tokens": [counter.count(t) for t in b["text"]]})
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")


def op6_tokens(spark, sf_dir):
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    import public_tokenizers
    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
