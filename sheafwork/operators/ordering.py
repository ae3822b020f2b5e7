"""Sort, limit, latest-period top-k and union (SRT)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest period, found by a scalar subquery."""
    return df.filter(F.col(period) == df.agg(F.max(period)).scalar())


def latest_top_k(
    df: DataFrame, period: str, floor: Column, order: Sequence[Column], k: int
) -> DataFrame:
    """SRT-03: best ``k`` rows of the newest period among rows passing ``floor``."""
    return latest_rows(df, period).filter(floor).orderBy(*order).limit(k)


def with_forced_rows(top: DataFrame, forced: DataFrame, key: str) -> DataFrame:
    """SRT-04: append ``forced`` rows whose key is not in ``top`` yet."""
    missing = forced.join(top.select(key), key, "left_anti")
    return top.unionByName(missing, allowMissingColumns=True)


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """SRT-05: union by name; absent columns become null."""
    out = first
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
