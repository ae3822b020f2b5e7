"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes triggers the ends of chunks, so a chunk depends
on its own content only. Each chunk gives one letter of a signature. The block
size (a power of two, the mean length of a chunk) is the smallest that gives at
most 64 chunks; a fingerprint holds the signatures of that size and of the next:
``level:signature:signature``. Triggers of a size are also triggers of the size
below.

Two fingerprints are compared by the edit distance (insertions and deletions)
of signatures of the same block size, so their levels may differ by one. The
likeness is ``1 - distance / (both lengths)``; without a run of four common
letters it is 0, which keeps chance out.

Defined cases: a null text is an empty one; its fingerprint is ``2::`` and two
empty texts have the likeness 1. Rows that agree in the id are ordered by text
(null first). A table of one row is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.jobs import record, stage, task_number
from sheafwork.llm.textops import byte_hashes, mix, text_chunks

ROLLING_BYTES = 7
SIGNATURE_CHUNKS = 64
FIRST_LEVEL = 2
LAST_LEVEL = 40
COMMON_RUN = 4
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _trigger_levels(data: np.ndarray) -> np.ndarray:
    """Trailing zero bits of the rolling hash that ends at each byte."""
    padded = np.concatenate([np.zeros(ROLLING_BYTES - 1, np.uint8), data, np.zeros(8, np.uint8)])
    window = np.ndarray((len(data),), "<u8", padded, strides=(1,)) & np.uint64((1 << 8 * ROLLING_BYTES) - 1)
    h = mix(window + np.uint64(1))
    return np.minimum(np.bitwise_count(~h & (h - np.uint64(1))), LAST_LEVEL).astype(np.int8)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Fingerprint of every text of a batch."""
    n = len(offsets) - 1
    if n == 0:
        return []
    if len(data) == 0:
        return [f"{FIRST_LEVEL}::"] * n
    level = _trigger_levels(data)
    # Rolling windows do not reach across documents: the first bytes never trigger.
    sizes = np.diff(offsets)
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    level[inside < ROLLING_BYTES - 1] = -1
    ends = np.flatnonzero(level >= FIRST_LEVEL)
    end_doc = np.searchsorted(offsets, ends, "right") - 1
    end_level = level[ends]
    chosen = np.full(n, LAST_LEVEL)
    # Chunks at a level: its triggers plus the rest behind the last one.
    for k in range(LAST_LEVEL, FIRST_LEVEL - 1, -1):
        count = np.bincount(end_doc[end_level >= k], minlength=n) + 1
        fits = (count <= SIGNATURE_CHUNKS) & (chosen == min(k + 1, LAST_LEVEL))
        chosen[fits] = k
    first, second = (_signatures(data, offsets, ends, end_doc, end_level, chosen + d) for d in (0, 1))
    return [f"{k}:{a}:{b}" for k, a, b in zip(chosen, first, second)]


def _signatures(data, offsets, ends, end_doc, end_level, chosen) -> list[str]:
    n = len(offsets) - 1
    cut = ends[end_level >= chosen[end_doc]] + 1
    full = np.flatnonzero(np.diff(offsets))
    stops = np.unique(np.concatenate([cut, offsets[1:][full]]))
    starts = np.append(0, stops[:-1])
    letters = LETTERS[(byte_hashes(data, starts, stops) & np.uint64(63)).astype(np.int64)].tobytes().decode()
    first = np.searchsorted(starts, offsets)
    return [letters[first[i] : first[i + 1]] for i in range(n)]


def _grid(signatures: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in signatures], np.int64)
    flat = np.frombuffer("".join(signatures).encode(), np.uint8)
    grid = np.zeros((len(size), SIGNATURE_CHUNKS), np.uint8)
    grid[np.arange(SIGNATURE_CHUNKS) < size[:, None]] = flat
    return grid, size


def _signature_likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness of pairs of signatures of one block size."""
    x, nx = _grid(a)
    y, ny = _grid(b)
    y[y == 0] = 1  # padding never matches
    # Bit-parallel longest common subsequence: a zero bit of v is a match.
    v = np.full(len(nx), ~np.uint64(0))
    for j in range(SIGNATURE_CHUNKS):
        same = np.packbits(x == y[:, j : j + 1], axis=1, bitorder="little").view(np.uint64)[:, 0]
        hit = v & same
        v = (v + hit) | (v & ~same)
    common = np.bitwise_count(~v).astype(np.int64)
    run = np.minimum(COMMON_RUN, np.minimum(nx, ny))
    shared = np.zeros(len(nx), dtype=bool)
    for n in range(1, COMMON_RUN + 1):
        which = np.flatnonzero(run == n)
        if len(which):
            shared[which] = _have_common_run(x[which], y[which], n)
    return np.where(shared & (nx + ny > 0), 2 * common / np.maximum(nx + ny, 1), 0.0)


def _have_common_run(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    def runs(grid):
        out = np.zeros((len(grid), SIGNATURE_CHUNKS - n + 1), np.uint64)
        for k in range(n):
            out = out * np.uint64(256) + grid[:, k : k + out.shape[1]]
        return out

    # Padding differs in x (0) and y (1); a run that reaches into it never matches.
    a, b = runs(x), runs(y)
    found = np.zeros(len(x), dtype=bool)
    for j in range(a.shape[1]):
        found |= (a == b[:, j : j + 1]).any(axis=1)
    return found


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of pairs of fingerprints."""
    if not a:
        return np.zeros(0)
    pa_, pb_ = ([f.split(":") for f in side] for side in (a, b))
    ka, kb = (np.array([int(p[0]) for p in side]) for side in (pa_, pb_))
    out = np.zeros(len(a))
    for da, db in ((1, 1), (2, 2), (1, 2), (2, 1)):
        which = np.flatnonzero(ka + da == kb + db)
        if len(which):
            score = _signature_likeness([pa_[i][da] for i in which], [pb_[i][db] for i in which])
            out[which] = np.maximum(out[which], score)
    out[[x == y for x, y in zip(a, b)]] = 1.0
    return out


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_RESULT = [c.strip().split(" ")[0] for c in _COLUMNS.split(",")]


def _encode(texts: list[str]) -> list[str]:
    out: list[str] = []
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    for _, data, offsets in text_chunks(iter([batch]), "text"):
        out += fingerprints(data, offsets)
    return out


def _compare(ids, texts: list[str], prints: list[str], following: list[str], next_prints: list[str]) -> dict:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    changed_prints = _encode(changed)
    return {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array(prints, pa.string()),
        "edited_fingerprint": pa.array(changed_prints, pa.string()),
        "near_edited": pa.array(likeness(prints, changed_prints), pa.float64()),
        "near_next": pa.array(likeness(prints, next_prints), pa.float64()),
    }


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of documents in order: all but its last one have their next at hand.

    The first and the last document of the range are handed on with their text.
    """
    task, held, opened = task_number(), None, False
    for batch, data, offsets in text_chunks(batches, "_text"):
        ids = batch.column("_id").to_pylist()
        texts = batch.column("_text").fill_null("").to_pylist()
        prints = fingerprints(data, offsets)
        if not opened:
            opened = True
            yield _edge(task, "first", ids[0], texts[0], prints[0])
        if held:
            ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
        held = (ids[-1], texts[-1], prints[-1])
        if len(ids) > 1:
            rows = _compare(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            n = len(ids) - 1
            yield record(
                **rows, task=pa.array([task] * n, pa.int64()), role=pa.array(["row"] * n),
                text=pa.nulls(n, pa.string()),
            )
    if held:
        yield _edge(task, "last", *held)


def _edge(task: int, role: str, doc_id, text: str, print_: str) -> pa.RecordBatch:
    none = {c: pa.nulls(1, t) for c, t in (("n", pa.int64()), ("s", pa.string()), ("d", pa.float64()))}
    return record(
        doc_id=pa.array([doc_id], pa.int64()), n_chars=none["n"], edited_sha256=none["s"],
        fingerprint=pa.array([print_]), edited_fingerprint=none["s"], near_edited=none["d"], near_next=none["d"],
        task=pa.array([task], pa.int64()), role=pa.array([role]), text=pa.array([text], pa.string()),
    )


def _edge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            c = {name: b.column(name).to_pylist() for name in b.schema.names}
            yield record(**_compare(c["doc_id"], c["text"], c["fingerprint"], c["next_text"], c["next_fingerprint"]))


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each document, of its edited text, and their likenesses.

    One range shuffle brings the documents in order; only the documents at the
    edges of the ranges (two for each task) are matched across tasks.
    """
    spark = docs.sparkSession
    ranged = (
        docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
        .repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    )
    staged = stage(ranged.mapInArrow(_in_order, f"{_COLUMNS}, task long, role string, text string"), "fingerprints")
    # One number for each task that had rows; the next range of the last is the first.
    tasks = sorted(r.task for r in staged.where("role = 'last'").select("task").collect())
    rows = staged.where("role = 'row'").select(*_RESULT)
    if not tasks:
        return rows
    follows = spark.createDataFrame(list(zip(tasks, tasks[1:] + tasks[:1])), "task long, next_task long")
    last = staged.where("role = 'last'").select("task", "doc_id", "text", "fingerprint")
    first = staged.where("role = 'first'").select(
        F.col("task").alias("next_task"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    pairs = last.join(follows, "task").join(first, "next_task").drop("task", "next_task")
    return rows.unionByName(pairs.mapInArrow(_edge_pairs, _COLUMNS))
