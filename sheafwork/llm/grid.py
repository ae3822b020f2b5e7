"""Query vectors against all vectors, in the tiles of a grid.

Rows are dealt to the columns of the grid by their place in the table that they
are read from, so copies of a row or a vector spread like any others (and a task
that runs again deals them alike); each column's rows go to every band of
queries, which are distinct rows and dealt by a hash. A tile streams its rows in blocks past its queries, which
it holds, so a task needs the memory of one block and of its queries' answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries of a band; rows of a column at most, and at least where there are idle tasks; rows of a block.
BAND_QUERIES = 1 << 13
COLUMN_ROWS = 1 << 20
LEAST_ROWS = 1 << 11
BLOCK_ROWS = 1 << 14


def finite(vector: str) -> Column:
    """True where the vector and all of its components are there and finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & good


def tiles(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int) -> DataFrame:
    """Both inputs, with columns of one schema, by ``tile``; in a tile the queries come first.

    The numbers only shape the grid; upper bounds will do.
    """
    spark = rows.sparkSession
    bands = max(1, -(-n_queries // BAND_QUERIES))
    idle = -(-2 * spark.sparkContext.defaultParallelism // bands)
    columns = max(1, -(-n_rows // COLUMN_ROWS), min(idle, -(-n_rows // LEAST_ROWS)))

    def dealt(df: DataFrame, place: Column, other: int, tile: Callable[[Column, Column], Column], is_row: bool) -> DataFrame:
        placed = df.select("*", place.cast("int").alias("_own"))
        met = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("_other"))
        return met.select(tile(F.col("_own"), F.col("_other")).alias("tile"), F.lit(is_row).alias("is_row"), *df.columns)

    all_rows = dealt(
        queries, F.pmod(F.xxhash64(*queries.columns), F.lit(bands)), columns, lambda band, column: band * columns + column, False
    ).unionByName(
        dealt(
            rows.select(*queries.columns), F.monotonically_increasing_id() % columns, bands,
            lambda column, band: band * columns + column, True,
        )
    )
    return all_rows.repartitionById(bands * columns, "tile").sortWithinPartitions("tile", "is_row")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        tile = batch.column("tile").to_numpy()
        is_row = batch.column("is_row").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(tile) != 0) | (is_row[1:] != is_row[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield int(tile[a]), bool(is_row[a]), batch.slice(a, b - a)


def stream(make: Callable[[pa.Table], object]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each tile ``make(queries)``, then ``add(block)`` for its rows, then what ``results()`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries, block, worker = None, [], [], None

        def meet():
            nonlocal worker, block
            if queries and block:
                worker = worker or make(pa.Table.from_batches(queries))
                worker.add(pa.Table.from_batches(block))
            block = []

        for tile, is_row, part in _runs(batches):
            if tile != at:
                meet()
                if worker:
                    yield from worker.results()
                at, queries, worker = tile, [], None
            if not is_row:
                queries.append(part)
                continue
            for lo in range(0, part.num_rows, BLOCK_ROWS):
                block.append(part.slice(lo, BLOCK_ROWS))
                if sum(b.num_rows for b in block) >= BLOCK_ROWS:
                    meet()
        meet()
        if worker:
            yield from worker.results()

    return run


def by_length(column: pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, row numbers, matrix)`` of the vectors of each length, as doubles."""
    column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for n in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == n)
        part = column if len(which) == len(sizes) else column.take(pa.array(which))
        yield n, which, part.flatten().to_numpy().astype(np.float64).reshape(len(which), n)
