"""Hard negatives by STR-packed R-trees over integer vectors.

Each block of rows gets a tree for every label: rows are sorted along the
coordinate of largest spread and cut into slabs, each slab along the next
coordinate, and so on (sort-tile-recursive); runs of ``LEAF`` rows are leaves
and runs of ``FANOUT`` nodes a node. A node's minimum bounding box gives an
interval of inner products for each coordinate, ``a * low`` to ``a * high``; their
sums bound the scores of all rows below. For each anchor a queue gives the box
of largest upper bound first; boxes outside all score windows, or strictly below
the k-th score that a window has already, are pruned. Answers and k-th scores
are carried from block to block, and the answers of all tiles are merged.

A first pass finds the positives, a second one the negatives, with one window
for each positive score.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component take no part. Ties go to the smaller id. "Other" rows are those of
another id than the anchor's. Rows of one id with one score count once, so that
repeated rows do not fill an anchor's answers; rows of one id that differ are
anchors, and candidates, each. Vectors of another length have no score. Scores
are whole numbers, computed without rounding; beyond a long they are its
largest or smallest value. A positive with a negative score has no negatives. An
empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm import grid
from sheafwork.llm.jobs import record, stage

LEAF, FANOUT = 128, 8
_LONG = 2**63 - 1


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as whole doubles."""
    with np.errstate(over="ignore"):
        return np.floor(scale * x)


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where their inner products stay below 2^53, else as Python's integers."""
    largest = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] * max(a.shape[1], 1) < 2**53:
        return a, b
    return tuple(np.array([int(v) for v in x.ravel().tolist()], dtype=object).reshape(x.shape) for x in (a, b))


def str_order(x: np.ndarray, rows: np.ndarray, axes: list[int]) -> Iterator[np.ndarray]:
    """Row numbers of each leaf, sort-tile-recursive over ``axes``."""
    pages = -(-len(rows) // LEAF)
    if pages <= 1 or not axes:
        yield from (rows[i : i + LEAF] for i in range(0, len(rows), LEAF))
        return
    slabs = int(np.ceil(pages ** (1 / len(axes)) - 1e-9))
    size = -(-pages // slabs) * LEAF
    rows = rows[np.argsort(x[rows, axes[0]], kind="stable")]
    for lo in range(0, len(rows), size):
        yield from str_order(x, rows[lo : lo + size], axes[1:])


class Tree:
    """Trees of all labels of a block; nodes of all levels are numbered through, leaves first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, order_by: np.ndarray):
        leaves, of = [], []
        for label in np.unique(labels):
            rows = np.flatnonzero(labels == label)
            pages = -(-len(rows) // LEAF)
            axes = np.argsort(-order_by[rows].var(axis=0), kind="stable")[: int(np.ceil(np.log2(max(pages, 2))))]
            for leaf in str_order(order_by, rows, axes.tolist()):
                leaves.append(leaf)
                of.append(label)
        order = np.concatenate(leaves)
        self.ids, self.x = ids[order], x[order]
        sizes = np.array([len(leaf) for leaf in leaves])
        begin, label = np.cumsum(sizes) - sizes, np.array(of)
        low, high = (f.reduceat(self.x, begin, axis=0) for f in (np.minimum, np.maximum))
        self.leaves = len(leaves)
        levels = [(low, high, begin, begin + sizes)]
        first = 0  # number of the level's first node
        while len(label) > len(np.unique(label)):
            new_label = np.append(True, label[1:] != label[:-1])
            at = np.arange(len(label)) - np.repeat(np.flatnonzero(new_label), np.diff(np.append(np.flatnonzero(new_label), len(label))))
            start = np.flatnonzero(at % FANOUT == 0)
            end = np.append(start[1:], len(label))
            low, high = np.minimum.reduceat(low, start, axis=0), np.maximum.reduceat(high, start, axis=0)
            levels.append((low, high, start + first, end + first))
            first += len(label)
            label = label[start]
        self.low, self.high, self.begin, self.end = (np.concatenate(c) for c in zip(*levels))
        self.roots, self.root_labels = first + np.arange(len(label)), label

    def interval(self, nodes, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest inner product with an anchor, of which ``up`` and ``down`` are the positive and negative parts."""
        low, high = self.low[nodes], self.high[nodes]
        return low @ up + high @ down, high @ up + low @ down


class Answers:
    """The k best rows of each score window of an anchor."""

    def __init__(self, k: int, windows: list[tuple[float, float]]):
        self.k, self.windows = k, windows
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in windows]
        self.least = [low for low, _ in windows]

    def wants(self, lower, upper) -> bool:
        return any(lower <= high and upper >= least for (_, high), least in zip(self.windows, self.least))

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (_, high) in enumerate(self.windows):
            good = np.flatnonzero((scores >= self.least[w]) & (scores <= high))
            if not len(good):
                continue
            heap, items = self.heaps[w], {(int(s), -int(i)) for s, i in zip(scores[good], ids[good])}
            for item in heapq.nlargest(self.k, items - set(heap)):
                if len(heap) < self.k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            if len(heap) == self.k:
                # Equal scores may still come with a smaller id.
                self.least[w] = max(self.least[w], heap[0][0])

    def search(self, tree: Tree, roots: np.ndarray, anchor: np.ndarray, own: int) -> None:
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        queue: list[tuple] = []

        def offer(nodes: np.ndarray) -> None:
            lower, upper = tree.interval(nodes, up, down)
            for lo, hi, node in zip(lower.tolist(), upper.tolist(), nodes.tolist()):
                if self.wants(lo, hi):
                    heapq.heappush(queue, (-hi, lo, node))

        offer(roots)
        while queue:
            upper, lower, node = heapq.heappop(queue)
            if not self.wants(lower, -upper):
                continue
            begin, end = tree.begin[node], tree.end[node]
            if node >= tree.leaves:
                offer(np.arange(begin, end))
                continue
            scores, ids = tree.x[begin:end] @ anchor, tree.ids[begin:end]
            self.take(scores[ids != own], ids[ids != own])


class Miner:
    """Anchors of a tile against its rows; same-label rows, or those of other labels in windows by positive scores."""

    def __init__(self, anchors: pa.Table, k: int, scale: float, percent: tuple[int, int] | None):
        self.scale, self.same = scale, percent is None
        columns = {c: anchors.column(c).to_pylist() for c in ("id", "key", "label", "positives")}
        self.anchors = list(zip(*columns.values()))
        self.vectors = {n: (which, whole(x, scale)) for n, which, x in grid.by_length(anchors.column("vector"))}
        self.answers = []
        for *_, positives in self.anchors:
            scores = sorted({p["score"] for p in positives or ()})
            windows = [(-np.inf, np.inf)] if self.same else [(-(-percent[0] * s // 100), percent[1] * s // 100) for s in scores]
            self.answers.append(Answers(k, windows))

    def add(self, block: pa.Table) -> None:
        ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
        for n, which, x in grid.by_length(block.column("vector")):
            if n not in self.vectors:
                continue
            x = whole(x, self.scale)
            own, vectors = self.vectors[n]
            anchors, rows = exact(vectors, x)
            tree = Tree(ids[which], labels[which], rows, x)
            for a, vector in zip(own.tolist(), anchors):
                anchor, _, label, _ = self.anchors[a]
                roots = tree.roots[(tree.root_labels == label) == self.same]
                if len(roots) and self.answers[a].windows:
                    self.answers[a].search(tree, roots, vector, anchor)

    def results(self) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for (anchor, key, _, positives), answers in zip(self.anchors, self.answers):
            if self.same:
                rows += [(anchor, key, None, None, -i, _long(s)) for s, i in answers.heaps[0]]
                continue
            by_score = dict(zip(sorted({p["score"] for p in positives}), answers.heaps))
            rows += [(anchor, key, p["id"], p["score"], -i, _long(s)) for p in positives for s, i in by_score[p["score"]]]
        if rows:
            names = ("anchor_id", "key", "positive_id", "positive_score", "id", "score")
            yield record(**{n: pa.array(v, pa.int64()) for n, v in zip(names, zip(*rows))})


def _long(x: int) -> int:
    return max(-_LONG - 1, min(_LONG, x))


_FOUND = "anchor_id long, key long, positive_id long, positive_score long, id long, score long"


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of all tiles, each id and score once."""
    merged = found.repartition("anchor_id", "key").dropDuplicates([*keys, "id", "score"])
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, percent: tuple[int, int] = (30, 90),
    scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor its ``positives`` best rows of the same label, and for each of
    those the ``negatives`` best rows of other labels whose score lies within
    ``percent`` of the positive's.
    """
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).where("id IS NOT NULL AND label IS NOT NULL")
    n_rows, n_anchors = named.count(), named.where("asks").count()
    good = named.where(grid.finite("vector"))
    kind = "array<struct<id:long,score:long>>"
    empty = F.lit(None).cast(kind).alias("positives")
    key = F.xxhash64("vector", "label").alias("key")
    anchors = good.where("asks").select("id", "label", "vector", key).dropDuplicates()
    everything = good.select("id", "label", "vector", F.lit(0).cast("long").alias("key"), empty)

    def mine(queries: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
        met = grid.tiles(queries, everything, n_anchors, n_rows)
        return met.mapInArrow(grid.stream(lambda q: Miner(q, k, scale, window)), _FOUND)

    same = _first(mine(anchors.withColumn("positives", empty), positives, None), ["anchor_id", "key"], positives)
    # At most ``positives`` rows for each anchor.
    best = same.groupBy("anchor_id", "key").agg(F.collect_list(F.struct("id", "score")).cast(kind).alias("positives"))
    asked = anchors.join(best, (anchors["id"] == best["anchor_id"]) & (anchors["key"] == best["key"]))
    asked = stage(asked.select("id", "label", "vector", anchors["key"], "positives"), "anchors")
    found = _first(mine(asked, negatives, percent), ["anchor_id", "key", "positive_id", "positive_score"], negatives)
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
