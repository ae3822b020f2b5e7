"""Line de-duplication over levelled sorted runs of line hashes.

A run is a table of line keys (128-bit hashes), bucketed and sorted by key. The
keys of a new batch, counted by the documents that hold them, meet all runs in
merge joins that read the runs as they lie, without shuffling or sorting them.
Keys that no run holds are new: the batch adds them as a run of its own to the
lowest level. Keys that a run holds raise its counts; the raises lie in the
same file, marked. When a level has ``fan_in`` runs they are merged into one run
of the next level, so that a batch meets few runs. A key is new in one run only.

Documents are then cleaned by the keys known from enough documents: their lines
go, all others stay.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
in lower case. Equal hashes count as equal keys (128 bits).

Defined cases: a null or empty text is one empty line; empty keys never go, and
a null text stays null. Every row counts as a document of its own. Rows with
one id are cleaned alike. All columns of the documents are kept; the two counts
added (``counts``: lines before, lines dropped) replace columns of their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sheafwork.llm.jobs import every, record
from sheafwork.workspace import fresh, stage

MIN_DOCS = 10
COUNTS = ("n_lines", "n_dropped")
FAN_IN = 3
BATCHES = 4
#: Keys of all batches in a bucket of the runs, and the most buckets a table may have.
BUCKET_KEYS = 1 << 18
MOST_BUCKETS = 100_000
_STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """Hash of a line's key; empty for an empty key."""
    line = line.strip(_STRIP).lower()  # bytes.lower() changes A-Z only
    return xxhash.xxh3_128_digest(line) if line else b""


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, keys = [], []
        for i, text in enumerate(batch.column("_text").to_pylist()):
            if text:
                found = {line_key(x) for x in text.encode().split(b"\n")} - {b""}
                at += [i] * len(found)
                keys += found
        yield record(
            _id=batch.column("_id").take(pa.array(at, pa.int64())), _hash=batch.column("_hash").take(pa.array(at, pa.int64())),
            _key=pa.array(keys, pa.binary()),
        )


def _named(docs: DataFrame, id_col: str, text_col: str) -> list:
    return [F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text")]


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct line keys of each row: ``_id``, ``_hash`` (of the text), ``_key``."""
    return docs.select(*_named(docs, id_col, text_col)).mapInArrow(_keys, "_id long, _hash long, _key binary")


def buckets_for(keys: int) -> int:
    """Buckets for runs that take this many keys."""
    return min(keys // BUCKET_KEYS + 1, MOST_BUCKETS)


@contextmanager
def _sorted_scans(spark: SparkSession):
    """Plans made inside use the order of bucketed tables: each bucket of a run is one sorted file."""
    setting = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@dataclass(frozen=True)
class Run:
    name: str
    path: str


class LineRuns:
    """Levelled runs of line keys below the shared folder.

    Runs are external tables of the session's catalog, since only those keep
    buckets; ``close`` forgets them there.
    """

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN, buckets: int = 8):
        self.spark, self.fan_in, self.buckets = spark, fan_in, buckets
        self.levels: list[list[Run]] = [[]]

    def _write(self, rows: DataFrame) -> Run:
        run = Run(f"line_run_{uuid.uuid4().hex}", fresh(self.spark, "line_run"))
        rows.write.bucketBy(self.buckets, "_key").sortBy("_key").option("path", run.path).saveAsTable(run.name, format="parquet")
        return run

    def _runs(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def _merged(self, runs: list[Run]) -> DataFrame:
        """Keys of runs with all their counts; old where no run has them as new.

        Read as plain files: the union of bucketed tables, aggregated by key, gives wrong
        results in Spark 4.1 (it takes the buckets of each table for those of the union).
        """
        rows = self.spark.read.schema("_key binary, _docs long, _old boolean").parquet(*[run.path for run in runs])
        return rows.groupBy("_key").agg(F.sum("_docs").alias("_docs"), F.min("_old").alias("_old"))

    def met(self, counts: DataFrame) -> DataFrame:
        """A batch's counted keys beside the runs: ``_old`` where a run holds the key."""
        rows = counts.repartition(self.buckets, "_key").withColumn("_old", F.lit(False))
        for run in self._runs():
            held = self.spark.table(run.name).where("not _old").select("_key", F.lit(True).alias("_held"))
            rows = rows.join(held.hint("merge"), "_key", "left").select(
                "_key", "_docs", (F.col("_old") | F.col("_held").isNotNull()).alias("_old")
            )
        return rows

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Add a batch as a new run; merge full levels."""
        self.add_keys(line_keys(docs, id_col, text_col))

    def add_keys(self, keys: DataFrame) -> None:
        """Add a batch given by its line keys (``_key``, one row for each document)."""
        counts = keys.groupBy("_key").agg(F.count("*").alias("_docs"))
        with _sorted_scans(self.spark):
            self.levels[0].append(self._write(self.met(counts)))
            level = 0
            while len(self.levels[level]) >= self.fan_in:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                full = self.levels[level]
                self.levels[level + 1].append(self._write(self._merged(full).repartition(self.buckets, "_key")))
                self.levels[level] = []
                self._forget(full)
                level += 1

    def _forget(self, runs: list[Run]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run.name}")

    def close(self) -> None:
        """Drop the runs' names from the catalog; the files stay."""
        self._forget(self._runs())
        self.levels = [[]]

    def known(self, min_docs: int = 1) -> DataFrame:
        """Keys that at least ``min_docs`` documents of all batches hold, written."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], "_key binary")
        return stage(self._merged(runs).where(F.col("_docs") >= min_docs).select("_key"), "known_lines")

    def clean(
        self, docs: DataFrame, min_docs: int = 1, id_col: str = "doc_id", text_col: str = "text",
        counts: tuple[str, str] = COUNTS, keys: DataFrame | None = None,
    ) -> DataFrame:
        """Documents without the lines that are known; adds the ``counts`` of lines and of dropped lines.

        ``keys`` are the documents' ``line_keys`` where they have been written.
        """
        docs = docs.drop(*counts)
        schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in counts]])
        # The known keys are a written table: Spark knows its size, and can split the lines of a very common key.
        keys = line_keys(docs, id_col, text_col) if keys is None else keys
        drop = keys.join(self.known(min_docs), "_key").groupBy("_id", "_hash").agg(F.collect_set("_key").alias("_drop"))
        columns = docs.columns

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, lines, dropped = [], [], []
                for text, gone in zip(batch.column("_text").to_pylist(), batch.column("_drop").to_pylist()):
                    parts = (text or "").encode().split(b"\n")
                    kept = parts
                    if gone:
                        gone = set(gone)
                        kept = [x for x in parts if line_key(x) not in gone]
                    lines.append(len(parts))
                    dropped.append(len(parts) - len(kept))
                    texts.append(None if text is None else b"\n".join(kept).decode())
                arrays = [
                    pa.array(texts, pa.string()) if c == text_col else batch.column(f"c{i}") for i, c in enumerate(columns)
                ]
                arrays += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

        carried = docs.select(
            *_named(docs, id_col, text_col),
            *[(F.lit(None) if name == text_col else c).alias(f"c{i}") for i, (name, c) in enumerate(zip(columns, every(docs)))],
        )
        same = carried["_id"].eqNullSafe(drop["_id"]) & (carried["_hash"] == drop["_hash"])
        return carried.join(drop, same, "left").drop("_id", "_hash").mapInArrow(apply, schema)


def drop_common_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text",
    counts: tuple[str, str] = COUNTS,
) -> DataFrame:
    """Drop lines that at least ``min_docs`` documents hold, in all documents.

    Texts are hashed in one scan, whose keys are written by batch.
    """
    part = F.pmod(F.xxhash64("_id"), F.lit(batches)).cast("int").alias("_batch")
    keys = stage(line_keys(docs, id_col, text_col).select("*", part), "line_keys", ["_batch"])
    runs = LineRuns(docs.sparkSession, buckets=buckets_for(keys.count()))
    for b in range(batches):
        runs.add_keys(keys.where(F.col("_batch") == b))
    cleaned = runs.clean(docs, min_docs, id_col, text_col, counts, keys)
    runs.close()
    return cleaned
