"""Registry of named queries and their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.session import apply_defaults


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``ids`` lists inventory rows."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_defaults(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, fn.__doc__
        REGISTRY[name] = Query(name, run, sql, ids)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str | Column) -> Column:
    """Two-decimal exact value, so that sums do not depend on row order."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def big(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("bigint")


def real(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("double")
