"""Mixture-controlled packing of token ids into fixed-length sequences.

Every source is a queue of tokens. Packing goes window by window: a window of
``window`` tokens, by default one sequence, takes from each queue its target
share. Deficit round-robin serves whole tokens, by due time, and carries the
rest to the next window. Token ``i`` of a queue with ``n`` of the ``N`` tokens
of a phase is due at ``(2 i + 1) N / (2 n)``; the first ``x`` tokens of a phase
are those due first (ties: the first queue). So windows are exactly full, every
task works out its documents' places by itself, and deficits carry over windows
and tasks alike. When a queue runs out a new phase begins with the shares of the
others, in the middle of a window, which the two phases fill together.

The windows, one after another, are one stream; sequences are cut from it, so
that only the last is not full.

Tokens are made once, in the tasks that read the documents, and staged with the
task number and the running total of each source in the task. Totals by task
and source give the queue positions, so no token is shuffled.

Defined cases: a null text is an empty one and has the end id only; a null
source is a queue of its own. Repeated rows are packed one by one. Sources with
a target of 0, or without one, come when all others have run out.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.encode import encoder
from sheafwork.llm.jobs import record, stage, task_number, task_offsets, tidy
from sheafwork.llm.textops import text_chunks

SEQUENCE_TOKENS = 2048
#: Tokens of a mixing window: every sequence has the target proportions.
WINDOW_TOKENS = SEQUENCE_TOKENS
#: Pieces of an output batch.
BATCH_PIECES = 1 << 12
_PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Layout:
    """Where each queue position lies in the stream."""

    def __init__(self, totals: list[int], targets: list[float] | None = None, window: int = WINDOW_TOKENS):
        self.window = window
        #: Per phase: position of each queue at its start, tokens taken, stream start.
        self.phases: list[tuple[list[int], list[int], int]] = []
        done, at = [0] * len(totals), 0
        while done != totals:
            take = self._phase([t - d for t, d in zip(totals, done)], targets)
            self.phases.append((done, take, at))
            done = [d + n for d, n in zip(done, take)]
            at += sum(take)
        self.tokens = at
        self._windows: dict[tuple[int, int], tuple[list[int], list[int]]] = {}

    @staticmethod
    def _phase(left: list[int], targets: list[float] | None) -> list[int]:
        if targets is None:
            return left
        share = [t if n else 0.0 for n, t in zip(left, targets)]
        if not sum(share) > 0:
            return left
        length, out_first = min((n / s, k) for k, (n, s) in enumerate(zip(left, share)) if s > 0)
        take = [min(n, int(length * s)) for n, s in zip(left, share)]
        take[out_first] = left[out_first]
        return take

    @staticmethod
    def _served(take: list[int], x: int) -> list[int]:
        """Tokens of each queue among the first ``x`` that are due in a phase."""
        total = sum(take)
        if x <= 0 or x >= total:
            return [0] * len(take) if x <= 0 else list(take)
        # Those due before x, then as many more or fewer as make it x.
        count = [((2 * n * x - 1) // total + 1) // 2 if n else 0 for n in take]
        over = sum(count) - x
        if over > 0:
            heap = [(-_due(total, take[k], c - 1), -k) for k, c in enumerate(count) if c]
        else:
            heap = [(_due(total, take[k], c), k) for k, c in enumerate(count) if c < take[k]]
        step = 1 if over < 0 else -1
        heapq.heapify(heap)
        for _ in range(abs(over)):
            k = abs(heap[0][1])
            count[k] += step
            if step > 0 and count[k] < take[k]:
                heapq.heapreplace(heap, (_due(total, take[k], count[k]), k))
            elif step < 0 and count[k]:
                heapq.heapreplace(heap, (-_due(total, take[k], count[k] - 1), -k))
            else:
                heapq.heappop(heap)
        return count

    def _window(self, phase: int, j: int) -> tuple[list[int], list[int], list[int]]:
        """Queue positions (in the phase) at the start and end of its window j, and where each part begins in the stream."""
        key = (phase, j)
        if key not in self._windows:
            if len(self._windows) > 4096:
                self._windows.clear()
            _, take, at = self.phases[phase]
            # A phase that begins within a window fills it up first.
            low, high = (max(i * self.window - at % self.window, 0) for i in (j, j + 1))
            before, after = self._served(take, low), self._served(take, high)
            place, begins = at + low, []
            for b, a in zip(before, after):
                begins.append(place)
                place += a - b
            self._windows[key] = before, after, begins
        return self._windows[key]

    def runs(self, queue: int, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """``(queue position, stream position, length)`` of the unbroken runs of a range of a queue."""
        for p, (done, take, at) in enumerate(self.phases):
            lo, hi = max(start - done[queue], 0), min(stop - done[queue], take[queue])
            total, n = sum(take), take[queue]
            while lo < hi:
                # The rank of a token differs from its due time by less than the number of queues.
                j = (_due(total, n, lo) + at % self.window) // self.window
                while lo < self._window(p, j)[0][queue]:
                    j -= 1
                while lo >= self._window(p, j)[1][queue]:
                    j += 1
                before, after, begins = self._window(p, j)
                end = min(hi, after[queue])
                yield done[queue] + lo, begins[queue] + lo - before[queue], end - lo
                lo = end


def _due(total: int, n: int, i: int) -> int:
    """When token ``i`` of a queue of ``n`` in a phase of ``total`` tokens is due."""
    return (2 * i + 1) * total // (2 * n)


def _id_type(tokenizer: str) -> str:
    return "<u2" if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def queue_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, id_col="doc_id", text_col="text", source_col="source"
) -> DataFrame:
    """Token ids of all documents, staged with task number and place in the task's part of the queue."""
    kind = _id_type(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task, total = encoder(tokenizer), task_number(), {}
        for batch, data, offsets in text_chunks(batches, "_text"):
            ids, first = tool.encode(data, offsets)
            ids = np.insert(ids, first[1:], end_id).astype(kind)
            sizes = np.diff(first) + 1
            stop = np.cumsum(sizes)
            sources, local = batch.column("_source").to_pylist(), []
            for s, n in zip(sources, sizes.tolist()):
                local.append(total.get(s, 0))
                total[s] = local[-1] + n
            yield record(
                task=pa.array([task] * len(sizes), pa.int64()), doc_id=batch.column("_id"), source=pa.array(sources, pa.string()),
                local=pa.array(local, pa.int64()), n_tokens=pa.array(sizes, pa.int64()),
                ids=pa.array([ids[e - n : e].tobytes() for e, n in zip(stop, sizes)], pa.binary()),
            )

    narrow = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).cast("string").alias("_source")
    )
    return stage(
        narrow.mapInArrow(tidy(run), "task long, doc_id long, source string, local long, n_tokens long, ids binary"), "queues"
    )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, targets: Mapping[str | None, float] | None = None,
    sequence: int = SEQUENCE_TOKENS, window: int | None = None, id_col="doc_id", text_col="text", source_col="source",
) -> DataFrame:
    """Pieces of documents with their sequence and offset.

    ``targets`` are token proportions by source; by default those of the
    documents, so that all queues run out together. One number for each source
    comes to the driver. The mixing window is a sequence unless ``window`` says otherwise.
    """
    queues = queue_tokens(docs, tokenizer, end_id, id_col, text_col, source_col)
    totals = sorted(
        ((r.source, int(r.n)) for r in queues.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()),
        key=lambda x: (x[0] is not None, x[0] or ""),
    )
    number = {s: k for k, (s, _) in enumerate(totals)}
    wanted = None if targets is None else [float(targets.get(s, 0.0)) for s, _ in totals]
    layout = Layout([n for _, n in totals], wanted, window or sequence)
    kind = _id_type(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, filled = np.empty((BATCH_PIECES, len(_PIECE)), np.int64), 0
        missing = np.zeros(BATCH_PIECES, bool)

        def full() -> pa.RecordBatch:
            columns = {c: pa.array(rows[:filled, k]) for k, c in enumerate(_PIECE)}
            columns["doc_id"] = pa.array(rows[:filled, 0], mask=missing[:filled])
            return record(**columns)

        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in ("doc_id", "source", "local", "before", "n_tokens")}
            for i, (doc, source, local, before, n) in enumerate(zip(*c.values())):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), kind).astype("<u4")
                begin = before + local
                for q, place, length in layout.runs(number[source], begin, begin + n):
                    at = q - begin
                    while length:
                        size = min(length, sequence - place % sequence)
                        crc = zlib.crc32(ids[at : at + size])
                        rows[filled] = (doc or 0, at, size, crc, n, place // sequence, place % sequence)
                        missing[filled] = doc is None
                        filled += 1
                        if filled == BATCH_PIECES:
                            yield full()
                            rows, filled = np.empty_like(rows), 0
                        at, place, length = at + size, place + size, length - size
        if filled:
            yield full()

    # One row for each task and source; written first, so that Spark knows its size.
    before = stage(
        task_offsets(queues, "n_tokens", ("source",)).select(F.col("task").alias("_t"), F.col("source").alias("_s"), "before"),
        "queue_offsets",
    )
    placed = queues.join(before, (queues["task"] == before["_t"]) & queues["source"].eqNullSafe(before["_s"]))
    return placed.select("doc_id", "source", "local", "before", "n_tokens", "ids").mapInArrow(
        tidy(run),
        ", ".join(f"{c} long" for c in _PIECE),
    )
