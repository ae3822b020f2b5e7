"""Sorted runs of hashed positions, shuffled as packed blobs.

A task cuts the positions of its documents into runs of bounded size. Of each
run the distinct keys go, sorted and gap-coded, to the tasks that own their
hash range ("bucket"); what those decide comes back by run. A key that occurs
often in a run is sent once, so a very common key costs a bucket at most one
entry for each run.
"""

from __future__ import annotations

import struct

import numpy as np

#: Positions of a run; small enough for a worker.
RUN_POSITIONS = 1 << 20
#: Entries a bucket should hold.
BUCKET_ENTRIES = 500_000
LEAST_BUCKET_BITS = 6


def bucket_bits(positions: int) -> int:
    """Bits of the bucket number for so many positions in all."""
    return max(LEAST_BUCKET_BITS, int(max(positions, 1) / BUCKET_ENTRIES).bit_length())


def _planes(values: np.ndarray) -> bytes:
    """Least number of bytes for all values, plane by plane."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(raw.T).tobytes()


def _from_planes(raw: memoryview, n: int) -> tuple[np.ndarray, memoryview]:
    width = raw[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw[1 : 1 + n * width], np.uint8).reshape(width, n).T
    return out.view("<u8")[:, 0], raw[1 + n * width :]


def pack_entries(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys with a value each."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return struct.pack("<I", len(keys)) + _planes(gaps) + _planes(values)


def unpack_entries(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    (n,) = struct.unpack_from("<I", blob)
    gaps, rest = _from_planes(memoryview(blob)[4:], n)
    values, _ = _from_planes(rest, n)
    return np.cumsum(gaps, dtype=np.uint64), values


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Sorted numbers."""
    return struct.pack("<I", len(numbers)) + _planes(np.diff(numbers.astype(np.uint64), prepend=np.uint64(0)))


def unpack_numbers(blob: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<I", blob)
    return np.cumsum(_from_planes(memoryview(blob)[4:], n)[0], dtype=np.uint64).astype(np.int64)


def split_buckets(keys: np.ndarray, values: np.ndarray, bits: int, bucket: int) -> list[tuple[int, bytes]]:
    """Blobs of sorted ``bits``-wide keys by their top ``bucket`` bits."""
    top = (keys >> np.uint64(bits - bucket)).astype(np.int64)
    edges = np.searchsorted(top, np.arange((1 << bucket) + 1))
    low = keys & np.uint64((1 << (bits - bucket)) - 1)
    return [(b, pack_entries(low[s:e], values[s:e])) for b, (s, e) in enumerate(zip(edges[:-1], edges[1:])) if e > s]
