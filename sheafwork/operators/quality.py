"""Data quality: logs, row rules, counters, skew reports and masks (QLT)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

METADATA = ("source_file", "ingested_at", "source_name")


def null_counts(df: DataFrame, skip: Sequence[str] = METADATA) -> DataFrame:
    """QLT-01: one row per column with its null count, from a single pass."""
    columns = [c for c in df.columns if c not in skip]
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n_null")) for c in columns])
    return wide.select("total_rows", F.inline(cells))


def quality_log(df: DataFrame, table_name: str, source_file: str, skip: Sequence[str] = METADATA) -> DataFrame:
    """QLT-01: the log row of a load: rows, null summary and time."""
    counts = null_counts(df, skip)
    found = F.array_sort(F.collect_list(F.when(F.col("n_null") > 0, F.struct("column", "n_null"))))
    return counts.agg(
        F.lit(table_name).alias("table_name"),
        F.lit(source_file).alias("source_file"),
        F.max("total_rows").alias("total_rows"),
        F.to_json(F.map_from_entries(found)).alias("null_summary"),
        F.current_timestamp().alias("logged_at"),
    )


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """QLT-02: raise when there is no row; reads at most one."""
    if df.isEmpty():
        raise ValueError(f"{label} is empty")
    return df


def table_summary(df: DataFrame, order: Sequence[str], n: int = 5) -> dict:
    """QLT-03: row count, schema and a small ordered sample."""
    return {
        "rows": df.count(),
        "schema": df.schema.simpleString(),
        "sample": [r.asDict() for r in df.orderBy(*order).limit(n).collect()],
    }


def check_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """QLT-04: add ``reasons``, the names of the rules a row breaks.

    A rule that evaluates to null counts as broken.
    """
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def split_rows(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """QLT-04: (valid rows, rejected rows with their reasons)."""
    checked = check_rows(df, rules)
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    return valid, checked.filter(F.size("reasons") > 0)


def require_valid(df: DataFrame, rules: Mapping[str, Column], label: str) -> DataFrame:
    """QLT-04: raise when any row breaks a rule."""
    _, rejected = split_rows(df, rules)
    first = rejected.select("reasons").limit(1).collect()
    if first:
        raise ValueError(f"{label}: broken rules {list(first[0][0])}")
    return df


def status_of(amount: Column) -> Column:
    """QLT-06: NULL, INVALID (not positive) or OK."""
    return F.when(amount.isNull(), "NULL").when(amount <= 0, "INVALID").otherwise("OK")


def counted(df: DataFrame, name: str, counters: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """QLT-06: count conditions while ``df`` is written by whatever action follows."""
    watch = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counters.items()]]
    return df.observe(watch, *exprs), watch


def key_skew(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """QLT-07: rows per key and the key's share of the table."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / df.agg(F.count(F.lit(1))).scalar())


def masked(
    df: DataFrame, masks: Mapping[str, Column], allowed: Column, row_filter: Column | None = None
) -> DataFrame:
    """QLT-09: hide columns unless ``allowed``; keep only rows passing ``row_filter``."""
    rows = df if row_filter is None else df.filter(row_filter)
    return rows.withColumns({c: F.when(allowed, F.col(c)).otherwise(mask) for c, mask in masks.items()})
