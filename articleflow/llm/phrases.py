"""Prefix-free parsing of byte strings: rolling-hash triggers cut phrases.

For matches of ``length`` bytes, every window of ``length`` bytes has an owner:
the gram of GRAM bytes with the least hash inside it (the leftmost of equal
ones).  The owner depends on the window's bytes alone, so equal windows have
equal owners at equal offsets, wherever they stand.  Neighbouring windows with
the same owner make up a phrase; phrases overlap by ``length - 1`` bytes, so
that each window lies in exactly one phrase (the overlap plays the part of the
trigger word that closes a phrase in prefix-free parsing).
"""

from __future__ import annotations

import numpy as np

from .common import mix64

GRAM = 32
#: Bytes parsed at a time.
CHUNK = 1 << 20


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Rolling hash of each gram (a power of two of bytes), by doubling."""
    h, size = mix64(data.astype(np.uint64) + np.uint64(1)), 1
    while size < gram:
        h = h[:-size] * np.uint64(0x9E3779B97F4A7C15 | 1 << size) + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    return mix64(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def parse(data: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of ``data`` (uint8): first window start, last window start and
    owner's hash of each."""
    h = gram_hashes(data, gram)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    owner = (_sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    last = np.append(first[1:] - 1, len(owner) - 1)
    return first, last, h[owner[first]]


def parse_texts(texts: list[bytes], length: int, gram: int = GRAM, chunk: int = CHUNK):
    """Yields (row, start in the row's text, buffer, first, last, hash) for runs
    of short texts parsed together and for pieces of long ones.  ``row`` and
    ``start`` have an entry for each phrase; ``first`` and ``last`` index the
    buffer."""
    todo, size = [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), chunk):
            piece = t[at:at + chunk + length - 1] if len(t) > chunk else t
            if len(piece) >= length:
                todo.append((k, at, piece))
                size += len(piece)
            if size >= chunk:
                yield _parse_run(todo, length, gram)
                todo, size = [], 0
    if todo:
        yield _parse_run(todo, length, gram)


def _parse_run(todo, length, gram):
    whole = b"".join(p for _, _, p in todo)
    data = np.frombuffer(whole, np.uint8)
    ends = np.cumsum([len(p) for _, _, p in todo])
    starts = ends - [len(p) for _, _, p in todo]
    first, last, h = parse(data, length, gram)
    # windows that cross the end of a piece are none: cut phrases there
    piece = np.searchsorted(ends, first, side="right")
    stop = np.searchsorted(ends, last, side="right")
    parts = [(first, last, h, piece)]
    cross = np.flatnonzero(stop > piece)
    extra = [(starts[p], last[c], h[c], p) for c in cross for p in range(piece[c] + 1, stop[c] + 1)]
    if extra:
        f, la, g, p = map(np.array, zip(*extra))
        parts.append((f, la, g.astype(np.uint64), p))
    first, last, h, piece = (np.concatenate(x) for x in zip(*parts))
    last = np.minimum(last, ends[piece] - length)
    ok = last >= first
    first, last, h, piece = first[ok], last[ok], h[ok], piece[ok]
    row = np.array([k for k, _, _ in todo])[piece]
    start = first - starts[piece] + np.array([at for _, at, _ in todo])[piece]
    return row, start, whole, first, last, h
