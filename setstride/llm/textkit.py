"""Vectorised word hashing over Arrow string columns.

A batch is taken in chunks of a few megabytes of UTF-8; every step runs over all bytes of a chunk at once, so
memory is bounded by the chunk or by the longest single text, and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all bits."""
    h = h ^ (h >> _U(32))
    h = h * _STEP
    h = h ^ (h >> _U(29))
    h = h * _MULT
    return h ^ (h >> _U(32))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _MULT)
_POWERS = np.ones(1, _U)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 1024), _STEP, _U)
        grown[0] = _U(1)
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of rows into the bytes) for consecutive rows of a string or binary column; nulls are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n = len(column)
    if not n:
        return
    column = column.fill_null(b"") if column.null_count else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, n)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between bytes marked in `blank`: hash of every word, index of the first word of every row (one more than rows), first and last byte (exclusive) of the words."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, _U), np.zeros(rows + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~blank[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    starts[edges] = inside[edges]
    first = np.flatnonzero(starts)
    if not len(first):
        return np.zeros(0, _U), np.zeros(rows + 1, np.int64), first, first
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    last = np.flatnonzero(stops) + 1
    size = last - first
    body = np.flatnonzero(inside)
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(body), dtype=np.int64) - np.repeat(begin, size)
    letters = data[body]
    value = _BYTE[LOWER[letters] if lower else letters] * _powers(int(size.max()))[place]
    hashed = mix(np.add.reduceat(value, begin) + size.astype(_U))
    return hashed, np.searchsorted(first, offsets).astype(np.int64), first, last


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, without regard to rows: entry i is for words i .. i + k - 1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = words[:n].copy()
    for j in range(1, k):
        h *= _STEP
        h += words[j : j + n]
    return mix(h)


def whole(words: np.ndarray) -> int:
    """Hash of a word sequence shorter than a shingle."""
    h = int(_MULT) ^ len(words)
    for w in words.tolist():
        h = (h * int(_STEP) + w) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([h], _U))[0])


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its k-word shingles); a shorter text is one shingle, a text without words none."""
    for row, data, offsets in text_chunks(column):
        words, index, _, _ = word_hashes(data, offsets)
        every = grams(words, k)
        for i in range(len(offsets) - 1):
            a, b = int(index[i]), int(index[i + 1])
            if b - a >= k:
                yield row + i, np.unique(every[a : b - k + 1])
            elif b > a:
                yield row + i, np.array([whole(words[a:b])], _U)
            else:
                yield row + i, np.zeros(0, _U)
