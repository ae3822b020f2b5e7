"""Nearest neighbours by a block matrix join of int8 codes.

A vector is coded as a scale and int8 numbers; the norm of what the code leaves
out is its error. For a block of queries and a block of rows one matrix product
of the codes (whole numbers below 2^24, so exact in single precision) gives the
distances between the coded vectors; a true distance differs by no more than
the two errors. Pairs whose lower bound lies above a query's bound, the k-th
smallest upper bound or the k-th distance found so far, are out. The others are
computed in double precision, component after component, and go into the
query's heap of k. Heaps of all tiles are merged by query.

So the answers are exact, not approximate: recall is 1.

Defined cases: vectors that are null, zero or hold a null or non-finite
component take no part, nor do rows without an id. Ties go to the smaller id. A
query's own rows are all rows of its id. Rows of one id at one distance from a
query count once, so repeated rows do not fill its answers. Vectors of another
length are not compared with a query. Of the rows of a block that hold one
vector only the k of smallest ids, besides the query's own, can be answers: the
others are left out exactly. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm import grid
from sheafwork.llm.jobs import record

#: Queries and rows of a product; pairs computed in double precision at a time.
TILE_QUERIES, TILE_ROWS = 1 << 9, 1 << 12
EXACT_PAIRS = 1 << 16
#: Components of one product: 127 * 127 * 1024 < 2^24.
PANEL = 1 << 10
#: Share of the norms that covers rounding of the bounds.
SLACK = 1e-7


class Coded:
    """Vectors with their int8 codes, scales, norms and errors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.columns = ids, np.ascontiguousarray(x.T)
        with np.errstate(over="ignore", invalid="ignore"):
            self.scale = np.abs(x).max(axis=1) / 127.0
            scale = np.where(self.scale > 0, self.scale, 1.0)[:, None]
            code = np.rint(x / scale)
            self.code = code.astype(np.int8)
            self.square = (code * code).sum(axis=1) * self.scale**2
            self.reach = np.sqrt((x * x).sum(axis=1))
            self.error = np.sqrt(((x - code * scale) ** 2).sum(axis=1)) + SLACK * self.reach

    def products(self, a: slice, other: Coded, b: slice) -> np.ndarray:
        total = 0.0
        for lo in range(0, self.code.shape[1], PANEL):
            left = self.code[a, lo : lo + PANEL].astype(np.float32)
            total = total + (left @ other.code[b, lo : lo + PANEL].astype(np.float32).T).astype(np.float64)
        return total


def first_copies(ids: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Rows to keep: of the rows with one vector those of the ``n`` smallest ids, each id once."""
    x = np.ascontiguousarray(x + 0.0)  # -0.0 is 0.0
    _, same = np.unique(x.view([("", np.void, x.dtype.itemsize * x.shape[1])]).ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    same, sorted_ids = same[order], ids[order]
    new_vector = np.append(True, same[1:] != same[:-1])
    new_id = new_vector | np.append(True, sorted_ids[1:] != sorted_ids[:-1])
    count = np.cumsum(new_id)
    rank = count - np.repeat(count[new_vector], np.diff(np.append(np.flatnonzero(new_vector), len(ids))))
    return np.sort(order[new_id & (rank < n)])


class Nearest:
    """Queries of a tile, with a heap of the k nearest rows for each."""

    def __init__(self, queries: pa.Table, k: int):
        self.k, self.queries = k, queries
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(queries.num_rows)]
        self.bound = np.full(queries.num_rows, np.inf)
        ids = queries.column("id").to_numpy()
        self.groups = {n: (which, Coded(ids[which], x)) for n, which, x in grid.by_length(queries.column("vector"))}

    def add(self, block: pa.Table) -> None:
        ids = block.column("id").to_numpy()
        for n, which, x in grid.by_length(block.column("vector")):
            if n in self.groups:
                keep = first_copies(ids[which], x, self.k + 1)
                rows = Coded(ids[which][keep], x[keep])
                own, queries = self.groups[n]
                for a in range(0, len(own), TILE_QUERIES):
                    for b in range(0, len(keep), TILE_ROWS):
                        self._meet(own, queries, slice(a, a + TILE_QUERIES), rows, slice(b, b + TILE_ROWS))

    def _meet(self, own: np.ndarray, queries: Coded, a: slice, rows: Coded, b: slice) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            square = queries.square[a, None] + rows.square[None, b]
            square -= (2 * queries.scale[a, None]) * rows.scale[None, b] * queries.products(a, rows, b)
            near = np.sqrt(np.maximum(square, 0))
            wide = (queries.error[a, None] + rows.error[None, b]) + SLACK * (queries.reach[a, None] + rows.reach[None, b])
        same = queries.ids[a, None] == rows.ids[None, b]
        near[same] = np.inf
        bound = self.bound[own[a]]
        if near.shape[1] > self.k:
            with np.errstate(invalid="ignore"):
                kth = np.partition(near + wide, self.k - 1, axis=1)[:, self.k - 1]
            bound = np.fmin(bound, kth)
        # A bound that overflowed is no bound: such pairs are computed.
        left, right = np.nonzero(~(near - wide > bound[:, None]) & ~same)
        for lo in range(0, len(left), EXACT_PAIRS):
            q, r = left[lo : lo + EXACT_PAIRS] + a.start, right[lo : lo + EXACT_PAIRS] + b.start
            total = np.zeros(len(q))
            with np.errstate(over="ignore"):
                for x, y in zip(queries.columns, rows.columns):
                    step = x[q] - y[r]
                    total += step * step
            self._push(own[q], rows.ids[r], np.sqrt(total))

    def _push(self, queries: np.ndarray, ids: np.ndarray, distances: np.ndarray) -> None:
        close = distances <= self.bound[queries]
        for q, i, d in zip(queries[close].tolist(), ids[close].tolist(), distances[close].tolist()):
            heap, item = self.heaps[q], (-d, -i)
            if len(heap) == self.k and item <= heap[0] or item in heap:
                continue
            (heapq.heappush if len(heap) < self.k else heapq.heapreplace)(heap, item)
            if len(heap) == self.k:
                self.bound[q] = -heap[0][0]

    def results(self) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(h) for h in self.heaps])
        if sizes.sum():
            query = np.repeat(np.arange(len(sizes)), sizes)
            found = [item for heap in self.heaps for item in heap]
            ids, keys = (self.queries.column(c).to_numpy()[query] for c in ("id", "key"))
            yield record(
                query_id=ids, key=keys, vec_id=np.array([-i for _, i in found], np.int64),
                score=np.array([-d for d, _ in found]),
            )


def nearest(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of every row for which ``is_query`` holds."""
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).where("id IS NOT NULL")
    n_rows, n_queries = named.count(), named.where("asks").count()
    good = named.where(grid.finite("vector") & F.exists("vector", lambda x: x != 0))
    queries = good.where("asks").select("id", "vector", F.xxhash64("vector").alias("key")).dropDuplicates()
    everything = good.select("id", "vector", F.lit(0).cast("long").alias("key"))
    found = grid.tiles(queries, everything, n_queries, n_rows).mapInArrow(
        grid.stream(lambda q: Nearest(q, k)), "query_id long, key long, vec_id long, score double"
    )
    # A query's rows from all tiles; an id and distance that several tiles found counts once.
    merged = found.repartition("query_id", "key").dropDuplicates(["query_id", "key", "vec_id", "score"])
    order = Window.partitionBy("query_id", "key").orderBy("score", "vec_id")
    return merged.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
