"""Vectorised word hashing over Arrow text batches (numpy, used inside Spark tasks).

Words are the maximal runs of bytes other than ``\\x20`` and ``\\x09-\\x0D`` of the
UTF-8 text, i.e. the regex ``[^\\x20\\x09-\\x0D]+``. A word's 64-bit hash depends
only on its bytes, so equal words hash alike in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Texts of one batch are taken together up to this many bytes at a time (a
#: longer text is taken alone), which bounds the memory of a task.
CHUNK_BYTES = 512 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): a bijection that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_CODES_LOWER = _CODES[_LOWER]

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base^i`` and ``base^-i`` for i < n, kept between batches."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a NULL counts as empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``[i, j)`` of at most ``limit`` bytes each (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte spans of all words of the rows, and per row
    the index of its first word (one more entry closes the last row)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SEPARATOR[data]
    begin = inside[1:-1] & ~inside[:-2]
    close = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] = inside[1:-1][edges]  # a word never runs over the end of its row
    close[edges - 1] = inside[1:-1][edges - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(close) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """The 64-bit hash of every word; ``lower`` folds A-Z first."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_CODES_LOWER if lower else _CODES)[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every ``n`` consecutive words (over row borders too: callers
    drop those that start within the last ``n - 1`` words of a row)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out *= np.uint64(_BASE)
        out += words[i : len(words) - n + 1 + i]
    return mix(out)


def batches_of(batch: pa.RecordBatch, text: str, lower: bool = False):
    """Word hashes of a batch in bounded chunks: yields ``(i, j, data, starts,
    ends, first, hashes)`` for rows ``[i, j)``; ``first`` indexes the words."""
    data, offsets = text_buffers(batch.column(text))
    for i, j in chunks(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = word_spans(part, offsets[i : j + 1] - offsets[i])
        yield i, j, part, starts, ends, first, word_hashes(part, starts, ends, lower)


# Byte classes of the classifiers' tokens: letters (any byte of a multi-byte
# character counts as one), digits, other signs; white space separates.
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[0x30:0x3A] = 2
_CLASS[0x41:0x5B] = 1
_CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1
_CLASS[_SEPARATOR] = 0
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)`` like :func:`word_spans`, for runs of one byte
    class (letters, digits or signs)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _CLASS[data]
    change = np.ones(len(data) + 1, dtype=bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    keep = kind[starts] != 0
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offsets)


def token_shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A small code per token: class, all / first / no capitals, length class;
    for signs the sign itself."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    caps = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_UPPER[data], out=caps[1:])
    n = ends - starts
    inside = caps[ends] - caps[starts]
    case = np.where(inside == 0, 0, np.where(inside == n, 2, np.where(_UPPER[data[starts]], 1, 3)))
    kind = _CLASS[data[starts]].astype(np.int64)
    size = np.minimum(n, 4)
    sign = np.where(kind == 3, data[starts].astype(np.int64), 0)
    return mix((((kind * 4 + case) * 8 + size) * 256 + sign).astype(np.uint64))
