"""User-defined functions, and the built-in forms that should replace them (UDF).

Preference order: a built-in expression, then a vectorised pandas function, then
a row function. Statistics over a group never come from inside a scalar pandas
function, which only sees one Arrow batch; they are computed by an aggregate and
joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork.operators.windows import with_group_stats

# Lowest score of each grade, best first.
GRADES = ((90, "A"), (75, "B"), (60, "C"))
LOWEST_GRADE = "F"


def grade(score: float | None) -> str | None:
    """UDF-01/03: letter grade; null stays null."""
    if score is None:
        return None
    return next((letter for floor, letter in GRADES if score >= floor), LOWEST_GRADE)


grade_udf = F.udf(grade, T.StringType(), useArrow=True)


def register_grade(spark: SparkSession, name: str = "grade_of") -> str:
    """UDF-02: make the grade function callable from SQL."""
    spark.udf.register(name, grade, T.StringType())
    return name


def grade_expr(score: Column) -> Column:
    """UDF-07: the same grades as a built-in expression."""
    chain = F.when(score.isNull(), F.lit(None))
    for floor, letter in GRADES:
        chain = chain.when(score >= floor, letter)
    return chain.otherwise(LOWEST_GRADE)


@F.udf(returnType=T.StringType(), useArrow=True)
def title_case(text: str | None) -> str | None:
    """UDF-01: decorator form."""
    return text.title() if text else None


@F.pandas_udf(T.StringType())
def upper_text(text: pd.Series) -> pd.Series:
    """UDF-04: Series in, Series out."""
    return text.str.upper()


@F.pandas_udf(T.DoubleType())
def standardised(value: pd.Series, mean: pd.Series, deviation: pd.Series) -> pd.Series:
    """UDF-04: z-score from given statistics; null where the deviation is 0."""
    return (value - mean) / deviation.where(deviation != 0)


def coded(table: dict[str, str]) -> Callable[[Column], Column]:
    """UDF-05: code lookup that prepares its table once per task, not per batch."""

    @F.pandas_udf(T.StringType())
    def lookup(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mapping = pd.Series(table)
        for codes in batches:
            yield codes.map(mapping)

    return lookup


def group_zscore(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """UDF-06: z-score within a group of any size.

    The statistics are one combined aggregate; only the arithmetic is vectorised
    Python.
    """
    stats = [F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_dev")]
    sized = with_group_stats(df, keys, stats)
    return sized.withColumn(name, standardised(F.col(value), "_mean", "_dev")).drop("_mean", "_dev")


def minmax_scaled(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Scale to [0, 1] within a group, built-ins only."""
    sized = with_group_stats(df, keys, [F.min(value).alias("_lo"), F.max(value).alias("_hi")])
    span = F.col("_hi") - F.col("_lo")
    return sized.withColumn(name, F.try_divide(F.col(value) - F.col("_lo"), span)).drop("_lo", "_hi")


def rank_series(series: DataFrame, key: str, value: str, tie: str, schema: str) -> DataFrame:
    """UDF-06: grouped-map rank (highest first) of short, already aggregated series.

    Every group becomes one pandas frame, so this is for groups whose size is
    bounded by their domain, such as the years of a country. Raw rows are ranked
    with ``sheafwork.operators.windows.ranked``.
    """

    def add_rank(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values([value, tie], ascending=[False, True])
        return ordered.assign(rank=range(1, len(ordered) + 1))

    return series.groupBy(key).applyInPandas(add_rank, schema)
