"""Removal of repeated passages by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document. Every document is cut
into reference blocks of half a window, one after another from its start; any
window holds a whole block. All rolling windows of block length probe the
blocks: a probe hits if an equal block stands elsewhere. So of two equal
windows each has a hit, at the same distance from its start, as the first one's
block is the second one's probe. Around the hits the windows are extended to
full length and compared exactly (64-bit hashes of the word sequences); each
one that also starts earlier, by document id and place, goes with all its words.
Windows that overlap make up a maximal repeat.

Blocks and probes travel as packed sorted runs (``runs.py``). Texts travel only
for documents with hits, found by a bitmap of fixed size. Hits are judged by a
hash whose width follows from the size of the corpus; a false one only means
some windows more to compare.

Defined cases: a null text has no words and stays null. The kept words are
joined by one space. Rows with equal id and text are one document and get one
result; texts under one id are ordered by their hash. A null id comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.jobs import record, stage, task_number
from sheafwork.llm.runs import (
    RUN_POSITIONS, bucket_bits, pack_numbers, split_buckets, unpack_entries, unpack_numbers,
)
from sheafwork.llm.textops import byte_hashes, text_chunks, windows, word_spans

WINDOW = 20
BLOCK = WINDOW // 2
#: Bits of the filter for documents with hits.
FILTER_BITS = 1 << 23
_RUN_SCHEMA = "kind int, run long, bucket int, blob binary, ids binary, first binary"


def hash_bits(positions: int) -> int:
    """Width at which one in some thousand probes hits a wrong block."""
    return min(64, max(40, int(max(positions, 1)).bit_length() + 13))


class _Run:
    """Positions of consecutive documents and what is sent of them."""

    def __init__(self, number: int, bits: int, bucket: int, aligned: bool):
        self.number, self.bits, self.bucket, self.aligned = number, bits, bucket, aligned
        self.keys: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.first: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.words = 0

    def add(self, ids: np.ndarray, first: np.ndarray, at: np.ndarray, keys: np.ndarray) -> None:
        """Documents with ids [n, 3], word starts (n + 1), and keys of the windows at some words."""
        self.ids.append(ids)
        self.first.append(first[1:] + self.words)
        self.places.append(at + self.words)
        self.keys.append(keys >> np.uint64(64 - self.bits) if self.bits < 64 else keys)
        self.words += int(first[-1])

    def rows(self) -> pa.RecordBatch:
        keys, places = np.concatenate(self.keys), np.concatenate(self.places)
        first = np.concatenate(self.first)
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(keys)))
        # Value of an entry: its first place, whether it occurs again, whether one place is a block.
        block = np.zeros(len(keys), dtype=bool)
        if self.aligned:
            start = first[np.searchsorted(first, places, "right") - 1]
            block = (places - start) % BLOCK == 0
        any_block = np.logical_or.reduceat(block, begin) if len(begin) else block
        values = (places[begin] << 2 | (sizes > 1) << 1 | any_block).astype(np.uint64)
        sent = split_buckets(keys[begin], values, self.bits, self.bucket)
        # Further places of a key stay behind, with the key's first place.
        again = ~new
        heads = np.repeat(places[begin], sizes - 1)
        by_head = np.lexsort((places[again], heads))
        rest = np.stack([heads[by_head], places[again][by_head]]).astype("<u4").tobytes()
        n = len(sent)
        return record(
            kind=pa.array([0] * n + [1], pa.int32()), run=pa.array([self.number] * (n + 1), pa.int64()),
            bucket=pa.array([b for b, _ in sent] + [-1], pa.int32()), blob=pa.array([x for _, x in sent] + [rest], pa.binary()),
            ids=pa.array([None] * n + [np.concatenate(self.ids).astype("<i8").tobytes()], pa.binary()),
            first=pa.array([None] * n + [first.astype("<i8").tobytes()], pa.binary()),
        )


def _id_rows(batch: pa.RecordBatch) -> np.ndarray:
    """Id, null mark and text hash of each row, [n, 3]."""
    ids = batch.column("_id")
    return np.stack([
        ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
        batch.column("_hash").to_numpy(),
    ], axis=1)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(data, offsets)
    return (byte_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)), first


def _probe_runs(bits: int, bucket: int) -> Callable:
    """Runs of all rolling windows of block length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = task_number() << 24
        part = _Run(number, bits, bucket, True)
        for batch, data, offsets in text_chunks(batches, "_text"):
            words, first = _words(data, offsets)
            if part.words and part.words + len(words) > RUN_POSITIONS:
                yield part.rows()
                number += 1
                part = _Run(number, bits, bucket, True)
            part.add(_id_rows(batch), first, *windows(words, first, BLOCK))
        if part.words:
            yield part.rows()

    return run


def _window_runs(bucket: int) -> Callable:
    """Runs of the full windows around hits; rows come in document order, hits before text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = task_number() << 24
        part = _Run(number, 64, bucket, False)
        hits: tuple | None = None
        last: tuple | None = None
        for batch, data, offsets in text_chunks(batches, "_text"):
            ids = _id_rows(batch)
            keep, places = [], []
            for i, (key, blob) in enumerate(zip(map(tuple, ids.tolist()), batch.column("_places"))):
                if blob.is_valid:
                    hits = key, unpack_numbers(blob.as_py())
                elif hits and key == hits[0] and key != last:
                    keep.append(i)
                    places.append(hits[1])
                    last = key
            if not keep:
                continue
            words, first = _words(data, offsets)
            sizes = np.diff(first)[keep]
            index = np.concatenate([np.arange(first[i], first[i + 1]) for i in keep])
            begin = np.append(0, np.cumsum(sizes))
            at, h = windows(words[index], begin, WINDOW)
            near = np.zeros(len(index) + 1, np.int64)
            for b, e, p in zip(begin[:-1], begin[1:], places):
                np.add.at(near, b + np.maximum(p - (WINDOW - BLOCK), 0), 1)
                np.add.at(near, np.minimum(b + p + 1, e), -1)
            wanted = np.cumsum(near[:-1])[at] > 0
            if part.words and part.words + len(index) > RUN_POSITIONS:
                yield part.rows()
                number += 1
                part = _Run(number, 64, bucket, False)
            part.add(ids[keep], begin, at[wanted], h[wanted])
        if part.words:
            yield part.rows()

    return run


def _entries_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, values and run numbers of a bucket, sorted by key and run."""
    keys, values, runs = [], [], []
    for number, blob in zip(table.column("run").to_pylist(), table.column("blob")):
        k, v = unpack_entries(blob.as_py())
        keys.append(k)
        values.append(v)
        runs.append(np.full(len(k), number, np.int64))
    keys, values, runs = np.concatenate(keys), np.concatenate(values), np.concatenate(runs)
    order = np.lexsort((runs, keys))
    return keys[order], values[order], runs[order]


def _by_run(runs: np.ndarray, places: np.ndarray) -> pa.Table:
    order = np.lexsort((places, runs))
    runs, places = runs[order], places[order]
    numbers, begin = np.unique(runs, return_index=True)
    edges = np.append(begin, len(runs))
    blobs = [pack_numbers(places[s:e]) for s, e in zip(edges[:-1], edges[1:])]
    return pa.table({"run": pa.array(numbers, pa.int64()), "places": pa.array(blobs, pa.binary())})


def _hits(table: pa.Table) -> pa.Table:
    """Places whose key has a block and occurs at least twice."""
    keys, values, runs = _entries_of(table)
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(begin, len(keys)))
    block = np.bitwise_or.reduceat(values & np.uint64(1), begin) > 0
    twice = (sizes > 1) | (np.bitwise_or.reduceat(values & np.uint64(2), begin) > 0)
    hit = np.repeat(block & twice, sizes)
    return _by_run(runs[hit], (values[hit] >> np.uint64(2)).astype(np.int64))


def _later(table: pa.Table) -> pa.Table:
    """First places in a run of keys that an earlier run has."""
    keys, values, runs = _entries_of(table)
    later = np.append(False, keys[1:] == keys[:-1])
    return _by_run(runs[later], (values[later] >> np.uint64(2)).astype(np.int64))


_PLACES = "_id long, _null long, _hash long, _places binary"


def _to_documents(every: bool) -> Callable:
    """Places by document. ``every``: all places of a hit key, else also all later places of any key."""

    def run(info: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {"_id": [], "_null": [], "_hash": [], "_places": []}
        if info.num_rows:
            ids = np.frombuffer(info.column("ids")[0].as_py(), "<i8").reshape(-1, 3)
            first = np.frombuffer(info.column("first")[0].as_py(), "<i8")
            heads, others = np.frombuffer(info.column("blob")[0].as_py(), "<u4").reshape(2, -1).astype(np.int64)
            blobs = [unpack_numbers(b.as_py()) for b in found.column("places")]
            places = np.unique(np.concatenate(blobs)) if blobs else np.zeros(0, np.int64)
            more = others[np.isin(heads, places)] if every else others
            places = np.unique(np.concatenate([places, more]))
            doc = np.searchsorted(first, places, "right") - 1
            numbers, begin = np.unique(doc, return_index=True)
            edges = np.append(begin, len(places))
            for d, s, e in zip(numbers, edges[:-1], edges[1:]):
                for name, v in zip(out, (*ids[d].tolist(), pack_numbers(places[s:e] - first[d]))):
                    out[name].append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})

    return run


def _decide(runs: DataFrame, rule: Callable, every: bool, name: str) -> DataFrame:
    found = runs.where("kind = 0").select("bucket", "run", "blob").groupBy("bucket").applyInArrow(rule, "run long, places binary")
    info = runs.where("kind = 1").select("run", "blob", "ids", "first")
    by_doc = info.groupBy("run").cogroup(found.groupBy("run")).applyInArrow(_to_documents(every), _PLACES)
    return stage(by_doc, name)


def _bit(hash_col: str = "_hash"):
    return F.col(hash_col).bitwiseAND(F.lit(FILTER_BITS - 1))


def _bitmap(rows: DataFrame) -> np.ndarray:
    """Fixed-size bitmap over the text hashes of some documents."""
    words = rows.select(F.shiftright(_bit(), 6).alias("w"), F.expr("shiftleft(1L, cast(_hash & 63 as int))").alias("v"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for w, v in words.groupBy("w").agg(F.bit_or("v")).collect():
        out[w] = v
    return out


def _picked(batches: Iterator[pa.RecordBatch], bits: np.ndarray, inside: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bit = batch.column("_hash").to_numpy() & (FILTER_BITS - 1)
        yield batch.filter(pa.array(((bits[bit >> 6] >> (bit & 63)) & 1 == 1) == inside))


def _filtered(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Documents that may be among those of the bitmap."""
    return docs.mapInArrow(lambda batches: _picked(batches, bits, True), docs.schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_chunks(batches, "_text"):
        starts, ends, first = word_spans(data, offsets)
        texts, removed = [], []
        has = batch.column("_text").is_valid().to_pylist()
        for i, blob in enumerate(batch.column("_places")):
            lo, hi = first[i], first[i + 1]
            keep = np.ones(hi - lo, dtype=bool)
            if blob.is_valid:
                gone = np.zeros(hi - lo + 1, np.int64)
                at = unpack_numbers(blob.as_py())
                np.add.at(gone, at, 1)
                np.add.at(gone, np.minimum(at + WINDOW, hi - lo), -1)
                keep = np.cumsum(gone[:-1]) == 0
            s, e = starts[lo:hi][keep], ends[lo:hi][keep]
            # Each kept word with one space behind it, the last one's cut off.
            size = e - s + 1
            index = np.arange(size.sum()) + np.repeat(s - (np.cumsum(size) - size), size)
            raw = data[np.minimum(index, len(data) - 1)] if len(index) else np.zeros(0, np.uint8)
            raw[np.cumsum(size) - 1] = 0x20
            texts.append(raw[:-1].tobytes().decode() if has[i] else None)
            removed.append(int((~keep).sum()))
        yield record(
            _id=batch.column("_id"), _text=pa.array(texts, pa.string()), n_words=pa.array(np.diff(first), pa.int64()),
            n_removed=pa.array(removed, pa.int64()),
        )


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, kept words (``text``), ``n_words`` and ``n_removed`` of every document."""
    named = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    keyed = named.withColumn("_hash", F.xxhash64("_text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    positions = int(size) // 6
    bucket = bucket_bits(positions)
    probes = stage(keyed.mapInArrow(_probe_runs(hash_bits(positions), bucket), _RUN_SCHEMA), "probe_runs")
    hits = _decide(probes, _hits, True, "anchor_hits")

    near = _filtered(keyed, _bitmap(hits)).select(
        "_id", F.col("_id").isNull().cast("long").alias("_null"), "_hash", F.lit(None).cast("binary").alias("_places"), "_text"
    )
    marks = hits.select(
        F.when(F.col("_null") == 0, F.col("_id")).alias("_id"), "_null", "_hash", "_places", F.lit(None).cast("string").alias("_text")
    )
    # Null text, that is the marks, sorts before the text of the same document.
    together = (
        near.unionByName(marks).repartitionByRange("_id", "_hash").sortWithinPartitions("_id", "_hash", F.col("_text").asc_nulls_first())
    )
    full = stage(together.mapInArrow(_window_runs(bucket), _RUN_SCHEMA), "window_runs")
    gone = _decide(full, _later, False, "repeats")

    bits = _bitmap(gone)
    schema = "_id long, _text string, n_words long, n_removed long"
    # Documents that surely lose nothing: picked and cut in one Python worker.
    unmarked = keyed.withColumn("_places", F.lit(None).cast("binary"))
    plain = unmarked.mapInArrow(lambda batches: _cut(_picked(batches, bits, False)), schema)
    marked = gone.select(F.when(F.col("_null") == 0, F.col("_id")).alias("_i"), F.col("_hash").alias("_h"), "_places")
    cut = _filtered(keyed, bits)
    cut = cut.join(marked, cut["_id"].eqNullSafe(marked["_i"]) & (cut["_hash"] == marked["_h"]), "left").drop("_i", "_h")
    kept = plain.unionByName(cut.select(*unmarked.columns).mapInArrow(_cut, schema))
    return kept.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), "n_words", "n_removed")
