"""Vectorised text helpers for Arrow batches.

Texts are handled as UTF-8 bytes of a whole batch: one byte array and the
offsets of the documents in it. A null text is an empty one. Words are runs of
bytes outside ``[\\x20\\x09-\\x0D]``; no UTF-8 continuation byte is in that set,
so byte runs and code-point runs are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

#: Bytes of text handled by one numpy pass; bounds the memory of a task.
CHUNK_BYTES = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64) of a string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches so that one piece holds about ``limit`` bytes of text, or one document."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, offsets = text_bytes(batch.column(column))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
            hi = min(n, max(lo + 1, hi))
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (in a new array)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(kind: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of the hash base, or of its inverse."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        table = np.full(size, kind, dtype=np.uint64)
        table[0] = 1
        have = np.multiply.accumulate(table)
        if size <= 1 << 22:
            _powers[kind] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for each span (values are uint64)."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=total[1:])
    h = total[ends] - total[starts]
    h *= _power(_INV, len(values) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(_BYTE[data], starts, ends)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word number of each document (n + 1)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    before &= ~cut[:-1]
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = word[1:]
    after &= ~cut[1:]
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all n-word windows that stay in one document, and their hashes."""
    if len(words) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    counts = np.diff(first)
    last = np.repeat(first[1:], counts)  # end of the document of each word
    at = np.flatnonzero(np.arange(len(words)) + n <= last)
    return at, span_hashes(words, at, at + n)


def sort_within(values: np.ndarray, first: np.ndarray) -> None:
    """Sort each part of an array, in place."""
    edges = first.tolist()
    for s, e in zip(edges[:-1], edges[1:]):
        if e - s > 1:
            values[s:e].sort()


def owner(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Document number of each position."""
    return np.searchsorted(first, at, "right") - 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def code_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points in each span."""
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total[ends] - total[starts]
