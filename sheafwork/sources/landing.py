"""Landing-zone discovery: which files are there, and which are new (SRC-11..14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions.nested import sorted_map


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SRC-14: path, modification time and size of every landed file.

    Only file metadata is read: the content column is pruned from the scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", F.col("length").alias("bytes"))
    )


def recent_files(files: DataFrame, n: int = 20) -> DataFrame:
    """SRC-14: the ``n`` newest files with their size in KB."""
    return (
        files.select("path", "modificationTime", (F.col("bytes") / 1024).alias("size_kb"))
        .orderBy(F.col("modificationTime").desc(), "path")
        .limit(n)
    )


def newest_per_group(files: DataFrame, group: Column) -> DataFrame:
    """SRC-13: the newest file of every group (for example its folder)."""
    order = F.struct("modificationTime", "path")
    return files.groupBy(group.alias("file_group")).agg(
        F.max_by(F.struct("path", "modificationTime", "bytes"), order).alias("f")
    ).select("file_group", "f.*")


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]+$", 1)


def not_loaded(rows: DataFrame, target: DataFrame | None, column: str = "source_file") -> DataFrame:
    """SRC-11: rows of files that the target table does not know yet.

    The set of loaded files stays a distributed anti-join; it is never collected.
    """
    if target is None:
        return rows
    return rows.join(target.select(column).distinct(), column, "left_anti")


def content_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SRC-12: md5 of every landed file's bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", F.md5("content").alias("content_hash"))
    )


def canonical_cube_hash(cubes: DataFrame) -> DataFrame:
    """SRC-12: hash that does not change when only the key order of the JSON does.

    ``cubes`` has the parsed cube columns of ``sheafwork.sources.cube``.
    """
    dimension = F.transform_values(
        "dimension",
        lambda _, d: F.to_json(F.struct(sorted_map(d["category"]["index"]).alias("index"))),
    )
    canonical = F.to_json(
        F.struct("id", "size", sorted_map(F.col("value")).alias("value"), sorted_map(dimension).alias("dimension"))
    )
    return cubes.select("source_file", "modified_at", F.md5(canonical).alias("content_hash"))


def new_content(hashes: DataFrame, known: DataFrame | None, path: str = "path", at: str = "modificationTime") -> DataFrame:
    """SRC-12: one file per unseen content: repeats and known hashes are skipped.

    Of several files with equal content the earliest is kept.
    """
    first = hashes.groupBy("content_hash").agg(F.min_by(path, F.struct(at, path)).alias(path))
    if known is None:
        return first
    return first.join(known.select("content_hash").distinct(), "content_hash", "left_anti")
