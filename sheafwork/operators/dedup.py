"""De-duplication policies (PRJ-20..22, QLT-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_rows(df: DataFrame) -> DataFrame:
    """PRJ-20: one copy of every row."""
    return df.distinct()


def drop_equal_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PRJ-21: one row per key, for inputs whose rows agree within a key."""
    return df.dropDuplicates(list(keys))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "latest") -> DataFrame:
    """PRJ-22: one row per key, chosen by ``order`` (``latest`` or ``first``).

    Equal ``order`` values are settled by the remaining columns, which makes the
    survivor the same on every run. The filter on the row number becomes a group
    limit below the shuffle: a map task sends one row per key, so a key that
    holds most of the table is no heavier than any other.
    """
    if keep not in ("latest", "first"):
        raise ValueError("keep must be 'latest' or 'first'")
    rest = [F.col(f.name) for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    direction = F.desc_nulls_last if keep == "latest" else F.asc_nulls_last
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*[direction(c) for c in [*order, *rest]]))
    return df.withColumn("_nth", first).filter(F.col("_nth") == 1).drop("_nth")


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """QLT-05: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], label: str) -> None:
    """Raise when a key repeats (looks at one offending key only)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{label}: key {list(keys)} is not unique")
