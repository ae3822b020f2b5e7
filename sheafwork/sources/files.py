"""Typed file scans (SRC-01..09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, **options: str) -> DataFrame:
    """SRC-01: CSV with a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", header).options(**options).csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """SRC-02: CSV whose unreadable rows keep their raw text in ``_corrupt_record``."""
    return read_csv(
        spark, path, f"{schema}, {CORRUPT} string",
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options,
    )


def infer_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """SRC-02: CSV with inferred types, for exploration (reads the data twice)."""
    return spark.read.option("header", True).option("inferSchema", True).options(**options).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """SRC-03: one JSON object per line, declared schema."""
    return spark.read.schema(schema).options(**options).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04/05: Parquet, partition columns taken from folder names."""
    return spark.read.parquet(path)


def number_range(spark: SparkSession, stop: int, start: int = 0, step: int = 1) -> DataFrame:
    """SRC-07: generated ids."""
    return spark.range(start, stop, step)


def file_table(spark: SparkSession, name: str, fmt: str, path: str, columns: str = "", **options: str) -> DataFrame:
    """SRC-09: a SQL table over existing files; dropping it keeps the files.

    The name goes through ``IDENTIFIER`` and the location is a literal parameter
    of the statement, so neither is spliced into SQL unchecked.
    """
    settings = ", ".join(f"'{_plain(k)}' '{_plain(v)}'" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:name) {'(' + columns + ')' if columns else ''} USING {_plain(fmt)} "
        f"{'OPTIONS (' + settings + ') ' if settings else ''}LOCATION '{_plain(path)}'",
        args={"name": name},
    )
    return spark.table(name)


def _plain(text: str) -> str:
    if "'" in text or "\\" in text:
        raise ValueError(f"quote in SQL text: {text!r}")
    return text
