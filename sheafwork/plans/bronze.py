"""PIP-01: bronze loads of landed files.

``ingest_csv`` and ``ingest_cubes`` are the loads for a growing folder: file
streams, drained, whose checkpoint remembers the files, so a load opens new
files only. ``load_csv`` and ``load_cubes`` compare a whole folder with a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.sources import cube
from sheafwork.sources.files import read_csv
from sheafwork.sources.landing import canonical_cube_hash, new_content, not_loaded
from sheafwork.streaming import io


def _with_metadata(rows: DataFrame, source_name: str) -> DataFrame:
    return rows.withColumns({"ingested_at": F.current_timestamp(), "source_name": F.lit(source_name)})


def load_csv(
    spark: SparkSession, landing: str, schema: str, source_name: str, target: DataFrame | None
) -> DataFrame:
    """Typed rows of all new CSV files, in one scan over the folder."""
    rows = read_csv(spark, landing, schema).withColumn("source_file", F.col("_metadata.file_path"))
    return _with_metadata(not_loaded(rows, target), source_name)


def load_cubes(
    spark: SparkSession,
    landing: str,
    dims: Sequence[str],
    source_name: str,
    target: DataFrame | None,
    pattern: str = "*.json",
) -> DataFrame:
    """Long rows of all new cube files, each with the ``content_hash`` of its file.

    A file is new when neither its path nor its content is in ``target``; files
    with equal content under several names count once. Broken documents are
    left to ``broken_cubes``.
    """
    cubes, _ = cube.split_documents(not_loaded(cube.read_cubes(spark, landing, pattern), target))
    fresh = new_content(canonical_cube_hash(cubes), target, "source_file", "modified_at")
    return _with_metadata(cube.decode(cubes.join(fresh, "source_file"), dims, ["content_hash"]), source_name)


def broken_cubes(spark: SparkSession, landing: str, pattern: str = "*.json") -> DataFrame:
    """Dead letters: text, path and time of every landed document that is not a whole cube."""
    return cube.split_documents(cube.read_cubes(spark, landing, pattern))[1]


def _ready(spark: SparkSession, path: str, schema: str) -> None:
    """Make the folder of a table of batches; with rows in it or not, nothing changes."""
    none = spark.createDataFrame([], f"{schema}, _feed string, _batch_id bigint")
    none.write.mode("append").partitionBy("_feed", "_batch_id").parquet(path)


def ingest_csv(spark: SparkSession, landing: str, schema: str, source_name: str, target: str, checkpoint: str) -> DataFrame:
    """Load the CSV files that the checkpoint does not know; returns input rows by micro-batch."""
    stream = io.file_stream(spark, landing, schema, "csv", header="true").withColumn("source_file", F.col("_metadata.file_path"))
    write = io.batch_writer(target)
    return io.drain_logged(spark, io.each_batch(stream, lambda b, i: write(_with_metadata(b, source_name), i)), checkpoint)


_HASHES = "content_hash string"


def ingest_cubes(
    spark: SparkSession, landing: str, dims: Sequence[str], source_name: str, target: str, checkpoint: str,
    pattern: str = "*.json", max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Load the cube files that the checkpoint does not know; returns files opened by micro-batch.

    Each document is read once. Content that an earlier batch had, or an earlier
    file of this batch, is skipped: the hashes of all loaded documents are a small
    table of their own (``<target>_hashes``). Broken documents go to
    ``<target>_broken``. A batch that runs again replaces what it had written.
    """
    cells = ", ".join([*(f"{d} string" for d in dims), "value double, source_file string, content_hash string, ingested_at timestamp, source_name string"])
    dead = "document string, source_file string, modified_at timestamp"
    for path, schema in ((target, cells), (f"{target}_hashes", _HASHES), (f"{target}_broken", dead)):
        _ready(spark, path, schema)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        whole, broken = cube.split_documents(cube.parse_documents(workspace.stage(batch, "cube_documents")))
        io.batch_writer(f"{target}_broken")(broken, batch_id)
        before = session.read.schema(f"{_HASHES}, _feed string, _batch_id bigint").parquet(f"{target}_hashes")
        known = before.where((F.col("_feed") != io.feed_of(batch)) | (F.col("_batch_id") != batch_id))
        fresh = workspace.stage(new_content(canonical_cube_hash(whole), known, "source_file", "modified_at"), "fresh_cubes")
        rows = cube.decode(whole.join(fresh, "source_file"), dims, ["content_hash"])
        io.batch_writer(target)(_with_metadata(rows, source_name), batch_id)
        io.batch_writer(f"{target}_hashes")(fresh.select("content_hash"), batch_id)

    stream = cube.stream_documents(spark, landing, pattern, max_files_per_trigger)
    return io.drain_logged(spark, io.each_batch(stream, load), checkpoint)
