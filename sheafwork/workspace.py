"""Shared scratch folders for jobs that stage tables between steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def root(spark: SparkSession) -> str:
    """The shared folder the cluster names; where it names none, a folder in its warehouse."""
    folder = spark.conf.get(_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    return folder.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder path below the shared root."""
    return f"{root(spark)}/sheafwork/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back.

    The written table cuts the lineage: later readers do not recompute ``df``,
    and losing an executor costs nothing that is not on shared storage.
    """
    spark = df.sparkSession
    path = fresh(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(_ordered_like(df, partition_by)).parquet(path)


def _ordered_like(df: DataFrame, partition_by: list[str] | None):
    from pyspark.sql.types import StructType

    if not partition_by:
        return df.schema
    kept = [f for f in df.schema.fields if f.name not in partition_by]
    return StructType(kept + [df.schema[c] for c in partition_by])
