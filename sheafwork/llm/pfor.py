"""Token ids in patched frame-of-reference files.

A file image holds the ids of consecutive documents:

    magic ``PFR2``; u32 documents, u32 blocks, u64 ids, u64 ids before the file
    in its range
    per document: u64 id, u8 null mark, u32 number of ids
    per block: u64 start of the block in the body (block index), u32 minimum,
               u8 width, u8 exceptions
    body: per block the packed values, then exception positions (u8) and values (u32)

Blocks hold 128 ids. The block minimum is subtracted; the width is the bits
that the given share of the block's values need; larger values are exceptions,
kept whole. Packed values lie in two 64-bit lanes: value ``2i + lane`` is the
i-th of its lane. The last block is filled up with its minimum.

``write_ids`` brings documents in ascending id order by one range shuffle and
writes the images as rows of a Parquet table through Spark, which gives them
its commit protocol and any file system; ``read_ids`` decodes them.

Defined cases: a null text is an empty one; every document gets the end id, so
none is empty. A null id comes first; rows with one id follow by text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.encode import encoder
from sheafwork.llm.jobs import record, stage, task_number, task_offsets
from sheafwork.llm.textops import text_chunks

BLOCK = 128
#: Share of a block's values that its width must hold.
PERCENTILE = 0.9
#: Ids of a file image; a longer document has an image of its own.
FILE_IDS = 1 << 20
_HEAD = np.dtype([("magic", "S4"), ("docs", "<u4"), ("blocks", "<u4"), ("ids", "<u8"), ("before", "<u8")])
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("size", "<u4")])
_INDEX = np.dtype([("at", "<u8"), ("low", "<u4"), ("width", "u1"), ("extra", "u1")])


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Low ``width`` bits of [n, 128] values as [n, 2 * width] 64-bit words."""
    lanes = values.astype(np.uint64).reshape(len(values), BLOCK // 2, 2) & np.uint64((1 << width) - 1)
    out = np.zeros((len(values), width, 2), np.uint64)
    for i in range(BLOCK // 2):
        word, shift = divmod(i * width, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out.reshape(len(values), 2 * width)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(len(words), width, 2)
    out = np.zeros((len(words), BLOCK // 2, 2), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK // 2):
        word, shift = divmod(i * width, 64)
        v = lanes[:, word] >> np.uint64(shift)
        if shift + width > 64:
            v |= lanes[:, word + 1] << np.uint64(64 - shift)
        out[:, i] = v & mask
    return out.reshape(len(words), BLOCK)


def write_image(ids: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray, before: int = 0) -> bytes:
    """File image of documents with the given ids (uint32, one after another)."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.uint32)
    grid.reshape(-1)[:n] = ids
    if n % BLOCK:
        grid[-1, n % BLOCK :] = grid[-1, : n % BLOCK].min()
    low = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    grid -= low[:, None]
    need = np.frexp(grid.astype(np.float64))[1].astype(np.uint8)  # bits of each value
    rank = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = np.partition(need, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.uint8)
    outlier = need > width[:, None]
    extra = outlier.sum(axis=1)
    size = 16 * width.astype(np.int64) + 5 * extra
    at = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        if w:
            packed = _pack(grid[which], int(w)).view(np.uint8).reshape(len(which), 16 * int(w))
            body[at[which, None] + np.arange(16 * int(w))] = packed
    block, position = np.nonzero(outlier)
    order = np.arange(len(block)) - np.repeat(np.cumsum(extra) - extra, extra)
    lists = at[block] + 16 * width[block].astype(np.int64)
    body[lists + order] = position
    values = grid[block, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    body[(lists + extra[block] + 4 * order)[:, None] + np.arange(4)] = values
    head = np.array([(b"PFR2", len(sizes), blocks, n, before)], _HEAD)
    docs = np.zeros(len(sizes), _DOC)
    docs["id"] = [0 if i is None else i for i in doc_ids]
    docs["null"] = [i is None for i in doc_ids]
    docs["size"] = sizes
    index = np.zeros(blocks, _INDEX)
    index["at"], index["low"], index["width"], index["extra"] = at, low, width, extra
    return head.tobytes() + docs.tobytes() + index.tobytes() + body.tobytes()


def _parts(image: bytes):
    head = np.frombuffer(image, _HEAD, 1)[0]
    if head["magic"] != b"PFR2":
        raise ValueError("not a token file")
    at = _HEAD.itemsize
    docs = np.frombuffer(image, _DOC, int(head["docs"]), at)
    at += docs.nbytes
    index = np.frombuffer(image, _INDEX, int(head["blocks"]), at)
    body = np.frombuffer(image, np.uint8, offset=at + index.nbytes)
    return head, docs, index, body


def _decode(index: np.ndarray, body: np.ndarray) -> np.ndarray:
    grid = np.zeros((len(index), BLOCK), np.uint32)
    at, width, extra = index["at"].astype(np.int64), index["width"].astype(np.int64), index["extra"].astype(np.int64)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        if w:
            packed = body[at[which, None] + np.arange(16 * w)]
            grid[which] = _unpack(packed.view(np.uint64).reshape(len(which), 2 * w), int(w))
    block = np.repeat(np.arange(len(index)), extra)
    order = np.arange(len(block)) - np.repeat(np.cumsum(extra) - extra, extra)
    lists = at[block] + 16 * width[block]
    values = body[(lists + extra[block] + 4 * order)[:, None] + np.arange(4)]
    grid[block, body[lists + order]] = np.ascontiguousarray(values).view("<u4").reshape(-1)
    return (grid + index["low"][:, None]).reshape(-1)


def read_image(image: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray, int]:
    """Inverse of ``write_image``: ids, document ids, sizes, ids before."""
    head, docs, index, body = _parts(image)
    ids = _decode(index, body)[: int(head["ids"])]
    names = [None if d["null"] else int(d["id"]) for d in docs]
    return ids, names, docs["size"].astype(np.int64), int(head["before"])


def read_range(image: bytes, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a file, decoding only the blocks that hold them."""
    head, _, index, body = _parts(image)
    stop = min(stop, int(head["ids"]))
    if start >= stop:
        return np.zeros(0, np.uint32)
    first = start // BLOCK
    return _decode(index[first : -(-stop // BLOCK)], body)[start - first * BLOCK : stop - first * BLOCK]


def write_ids(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Table of file images: ``task`` (range number), ``file`` (in the range), ``n_ids``, ``image``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task = encoder(tokenizer), task_number()
        held: list[tuple[np.ndarray, list, np.ndarray]] = []
        count = number = before = 0

        def flush():
            ids, names, sizes = (
                np.concatenate([h[0] for h in held]), [i for h in held for i in h[1]], np.concatenate([h[2] for h in held])
            )
            return record(
                task=pa.array([task], pa.int64()), file=pa.array([number], pa.int64()),
                n_ids=pa.array([len(ids)], pa.int64()), image=pa.array([write_image(ids, names, sizes, before)], pa.binary()),
            )

        for batch, data, offsets in text_chunks(batches, "_text"):
            ids, first = tool.encode(data, offsets)
            ids = np.insert(ids, first[1:], end_id)
            held.append((ids, batch.column("_id").to_pylist(), np.diff(first) + 1))
            count += len(ids)
            if count >= file_ids:
                yield flush()
                held, number, before, count = [], number + 1, before + count, 0
        if held:
            yield flush()

    ranged = (
        docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
        .repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    )
    return stage(ranged.mapInArrow(write, "task long, file long, n_ids long, image binary"), "token_files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for task, image in zip(batch.column("task").to_pylist(), batch.column("image")):
            ids, names, sizes, before = read_image(image.as_py())
            stop = np.cumsum(sizes)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            yield record(
                task=pa.array([task] * len(names), pa.int64()), doc_id=pa.array(names, pa.int64()),
                local=pa.array(before + stop - sizes, pa.int64()), n_tokens=pa.array(sizes, pa.int64()),
                ids_crc32=pa.array([zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(stop, sizes)], pa.int64()),
            )


def read_ids(files: DataFrame) -> DataFrame:
    """One row for each document in the files: where it starts, its size and checksum."""
    docs = files.select("task", "image").mapInArrow(
        _read, "task long, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    before = task_offsets(files, "n_ids")
    return docs.join(before, "task").select(
        "doc_id", (F.col("local") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
