"""JSON, array and map helpers (COL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, text: str, schema: str, into: str = "parsed") -> DataFrame:
    """COL-18: parse a JSON column; ``is_bad`` marks non-null text that does not parse.

    Malformed text gives a struct of nulls, so failure is read from the
    corrupt-record field instead of from null.
    """
    parsed = df.withColumn(into, F.from_json(text, f"{schema}, {CORRUPT} string"))
    bad = F.col(f"{into}.{CORRUPT}").isNotNull()
    return parsed.withColumns({"is_bad": bad, into: F.col(into).dropFields(CORRUPT)})


def route_json(df: DataFrame, text: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """COL-21: (parsed rows, dead-letter rows with their raw text)."""
    parsed = parse_json(df, text, schema)
    good = parsed.filter(~F.col("is_bad")).drop("is_bad")
    bad = parsed.filter("is_bad").drop("is_bad", "parsed")
    return good, bad


def sorted_map(column: Column) -> Column:
    """The same map with its entries in key order, for comparing and hashing."""
    return F.map_from_entries(F.array_sort(F.map_entries(column)))


def fold(items: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """COL-07/08: reduce an array to one value."""
    return F.aggregate(items, zero, step)


def joined(items: Column, separator: str = ",") -> Column:
    """Any array as delimited text."""
    return F.array_join(F.transform(items, lambda x: x.cast("string")), separator)
