"""Pivot, unpivot, chunked collection and summaries (AGG-10..19)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.operators.skew import ROWS_PER_TASK
from sheafwork.operators.windows import ranked


def wide_sums(
    df: DataFrame, keys: Sequence[str], category: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """AGG-14: one summed column per listed category, in a single shuffle.

    A key without rows of some category gets null there, as with ``pivot``.
    ``names`` maps category value to output column.
    """
    sums = [F.sum(F.when(F.col(category) == c, F.col(value))).alias(n) for c, n in names.items()]
    return df.groupBy(*keys).agg(*sums)


def pivot(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence, aggregates: Sequence[Column]
) -> DataFrame:
    """AGG-14/15: native pivot over an explicit value list."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(*aggregates)


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """AGG-18: wide to long."""
    return df.unpivot(list(keys), list(columns), name, value)


def collect_chunks(
    df: DataFrame, keys: Sequence[str], item: Column, spread_by: Sequence[str], limit: int = ROWS_PER_TASK
) -> DataFrame:
    """AGG-10: rows to sorted arrays, one array per key and chunk.

    The sorted items of a key are cut into chunks of ``limit`` items, numbered
    from 0: chunks joined in order are the sorted list. No row has to hold an
    unbounded group. ``spread_by`` orders equal items.
    """
    placed = ranked(df.withColumn("_item", item), keys, "_item", spread_by)
    return (
        placed.groupBy(*keys, F.floor((F.col("row_number") - 1) / F.lit(limit)).alias("chunk"))
        .agg(F.array_sort(F.collect_list("_item")).alias("items"))
    )


def summary(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """AGG-19: count, mean, stddev, min, quartiles and max of numeric columns.

    One pass over the table; one output row per column. The quartiles are
    approximate, with a rank error of at most 1 / ``accuracy`` of the rows.
    """
    stats: list[Column] = []
    for c in columns:
        quartiles = F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                quartiles[0].cast("double").alias("p25"),
                quartiles[1].cast("double").alias("p50"),
                quartiles[2].cast("double").alias("p75"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"s_{c}")
        )
    wide = df.agg(*stats)
    return wide.select(F.inline(F.array(*[F.col(f"s_{c}") for c in columns])))
