"""File layout: compaction, clustering and file reports (VER-11, 12, 14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.sources.landing import list_files


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """VER-14: file count, bytes and mean size of a table folder."""
    return list_files(spark, path, "*.parquet").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.avg("bytes").alias("mean_bytes"),
    )


def compact(df: DataFrame, path: str) -> None:
    """VER-11: rewrite into files of about the advisory partition size.

    The rebalance hint lets adaptive execution merge small and split large
    outputs (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    df.hint("rebalance").write.mode("errorifexists").parquet(path)


def compact_to(df: DataFrame, path: str, files: int) -> None:
    """VER-11: rewrite into a fixed number of evenly filled files."""
    df.repartition(files).write.mode("errorifexists").parquet(path)


def _bucket(value: Column, edges: Sequence) -> Column:
    """Number of edges at or below ``value``, as a balanced tree of comparisons; null is in the first bucket.

    The tree stays inside generated code and needs log2(edges) comparisons.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("bigint")
        middle = (low + high) // 2
        return F.when(value >= F.lit(edges[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(edges))


#: Rows of the sample that bucket edges are taken from.
SAMPLE_ROWS = 10_000


def bucket_edges(df: DataFrame, columns: Sequence[str], buckets: int, sample_rows: int = SAMPLE_ROWS) -> list[list]:
    """Values that cut each column, of any type that orders, into buckets of about equal rows.

    One pass takes a sample of ``sample_rows`` rows for all columns, whatever the
    size of the table. Ordering is Spark's, so texts, dates and decimals have
    edges like numbers. A value that holds many rows is one edge.
    """
    sample = df.select(*[F.col(c).alias(f"_c{j}") for j, c in enumerate(columns)]).orderBy(F.rand(7)).limit(sample_rows)
    found = []
    for j in range(len(columns)):
        # Nulls are first in order and get no edge.
        ordered = F.array_sort(F.collect_list(f"_c{j}"))
        at = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: (i * F.size(ordered) / buckets).cast("int"))
        found.append(F.array_distinct(F.filter(F.transform(at, lambda i: F.get(ordered, i)), lambda v: v.isNotNull())).alias(f"_c{j}"))
    row = sample.agg(*found).first()
    return [list(row[j] or []) for j in range(len(columns))]


def with_z_value(df: DataFrame, columns: Sequence[str], name: str, bits: int = 6) -> DataFrame:
    """VER-12: ``name``, the interleaved bits of each column's bucket; at most ``2 ** bits - 1`` edges a column."""
    edges = bucket_edges(df, columns, 2**bits)
    # A column for each key, so that a tree of comparisons runs once and not for every bit.
    parts = [f"{name}_{j}" for j in range(len(columns))]
    placed = df.withColumns({part: _bucket(F.col(c), e) for part, c, e in zip(parts, columns, edges)})
    z = F.lit(0).cast("bigint")
    for j, part in enumerate(parts):
        for i in range(bits):
            bit = F.shiftright(part, i).bitwiseAND(F.lit(1).cast("bigint"))
            z = z + F.shiftleft(bit, i * len(columns) + j)
    return placed.withColumn(name, z).drop(*parts)


ROWS_PER_FILE = 5_000_000


def files_for(df: DataFrame, at_least: int = 1, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Number of files for a table, from its row count."""
    return max(at_least, -(-df.count() // rows_per_file))


def z_order(df: DataFrame, columns: Sequence[str], path: str, files: int, bits: int = 6) -> None:
    """VER-12: write files in which rows close in all ``columns`` lie together."""
    placed = with_z_value(df, columns, "_z", bits)
    (
        placed.repartitionByRange(files, "_z")
        .sortWithinPartitions("_z")
        .drop("_z")
        .write.mode("errorifexists")
        .parquet(path)
    )


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lowest and highest value per file: what a reader can skip by."""
    bounds = []
    for c in columns:
        bounds += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), *bounds)
