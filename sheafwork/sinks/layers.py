"""Layer writes, exports and views (SNK)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """SNK-01/04: append; the first load creates the table folder."""
    _writer(df, fmt, "append", partition_by).save(path)


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """SNK-01: append to a catalog table, creating it on first load."""
    _table_writer(df, "append", path).saveAsTable(name)


def rewrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """SNK-02: replace a catalog table together with its schema."""
    _table_writer(df, "overwrite", path).saveAsTable(name)


def _table_writer(df: DataFrame, mode: str, path: str | None):
    writer = df.write.mode(mode).format("parquet")
    return writer.option("path", path) if path else writer


def create_from_query(spark: SparkSession, name: str, query: DataFrame, path: str | None = None) -> DataFrame:
    """SNK-08: CREATE TABLE ... AS SELECT, replacing an older table.

    With ``path`` the table is external: dropping it keeps the files.
    """
    if path and "'" in path:
        raise ValueError("quote in path")
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    location = f"LOCATION '{path}' " if path else ""
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:name) USING parquet {location}AS SELECT * FROM {{q}}", args={"name": name}, q=query
    )
    return spark.table(name)


def insert_rows(spark: SparkSession, name: str, rows: DataFrame, overwrite: bool = False) -> None:
    """SNK-09: INSERT INTO / INSERT OVERWRITE by position of the table's columns."""
    aligned = rows.select(*spark.table(name).columns)
    aligned.write.insertInto(name, overwrite=overwrite)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """SNK-06/07: folder-partitioned write with few, evenly sized files.

    The rebalance hint groups rows by partition value; adaptive execution then
    merges small values into one writer and splits a large value over several.
    An overwrite replaces only the partitions present in ``df``.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = _writer(balanced, "parquet", mode, partition_by)
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def export_single_file(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-03: one file for a serving layer, from an aggregated result.

    The result is shuffled to the writing task, so what computes it stays parallel.
    """
    writer = df.repartition(1).write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_files(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists") -> None:
    """SNK-04/05: CSV, JSON or Parquet with any save mode."""
    _writer(df, fmt, mode, ()).save(path)


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """SNK-11: keep ``df`` for several outputs and release it afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def publish_view(df: DataFrame, name: str, everywhere: bool = False) -> str:
    """SNK-12: temp view of the session, or of all sessions of the application."""
    if everywhere:
        df.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    df.createOrReplaceTempView(name)
    return name


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def ensure_schema(spark: SparkSession, name: str, comment: str = "") -> None:
    """SNK-13: create a layer schema when it is missing."""
    if not name.isidentifier() or "'" in comment:
        raise ValueError("plain schema name and comment expected")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{comment}'")


def catalog_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))


def catalog_columns(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str]):
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    return writer.partitionBy(*partition_by) if partition_by else writer
