"""Hard negatives and nearest neighbours against brute force, over odd rows and small tiles."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import grid, rtree, tilejoin
from sheafwork.llm.jobs import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, key string, tile int, VECTOR string, is_row string, asks int"


def asks():
    return F.col("vec_id") % 10 == 0


def _rows():
    rng = random.Random(3)
    vector = lambda: [float(np.float32(rng.gauss(0, 0.2))) for _ in range(6)]
    common = vector()
    rows = [(i, vector(), i % 3) for i in range(160)]
    rows += [(i, common, 1) for i in range(160, 260)]  # a third holds one vector
    rows += [(260, [0.0] * 6, 1), (270, [-0.0] * 6, 2), (280, None, 1), (290, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(300, [float("nan")] * 6, 1), (310, [float("inf")] + [0.0] * 5, 1), (320, vector(), None), (None, vector(), 1)]
    rows += [(330, [0.5, 0.25], 1), (331, [0.5, 0.5], 1), (332, [0.25, 0.5], 2), (340, [], 1), (350, [2.0**101] * 6, 0), (351, [2.0**100] * 6, 1)]
    rows += [rows[10]] * 30 + [(20, vector(), 2), (21, rows[20][1], 2)]  # a repeated row, one id with two vectors
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vectors") / "t")
    named = prepare(spark).createDataFrame([(*r, "k", 1, "v", "r", 2) for r in rows], SCHEMA)
    named.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(params=["as it is", "small tiles"])
def sizes(request, monkeypatch):
    if request.param == "small tiles":
        for name, value in (("BAND_QUERIES", 7), ("COLUMN_ROWS", 60), ("BLOCK_ROWS", 16)):
            monkeypatch.setattr(grid, name, value)


def _good(x):
    return x is not None and all(c is not None and math.isfinite(c) for c in x)


def _nearest(rows, k):
    good = {(i, tuple(x)) for i, x, _ in rows if i is not None and _good(x) and any(x)}
    out = []
    for q, x in good:
        if q % 10 == 0:
            found = set()
            for i, y in good:
                if i != q and len(x) == len(y):
                    total = 0.0
                    for a, b in zip(x, y):
                        total += (a - b) * (a - b)
                    found.add((math.sqrt(total), i))
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def test_nearest(table, rows, sizes):
    got = tilejoin.nearest(table, asks(), k=4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.schema["rank"].dataType.simpleString() == "int"
    assert sorted(map(tuple, got.collect())) == _nearest(rows, 4)


def test_bounds_hold():
    """Coded distances differ from the true ones by no more than the errors, also for many components and large values."""
    rng = np.random.default_rng(1)
    for width, scale in ((6, 1.0), (1500, 1e6), (3, 1e-20)):
        x, y = (rng.standard_normal((40, width)) * scale for _ in range(2))
        x[0] = y[0] = 5 * scale
        a, b = (tilejoin.Coded(np.arange(40), v) for v in (x, y))
        square = a.square[:, None] + b.square[None] - 2 * a.scale[:, None] * b.scale[None] * a.products(slice(None), b, slice(None))
        true = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
        wide = a.error[:, None] + b.error[None] + tilejoin.SLACK * (a.reach[:, None] + b.reach[None])
        assert (np.abs(np.sqrt(np.maximum(square, 0)) - true) <= wide).all()
        whole = a.code.astype(int) @ b.code.astype(int).T
        assert (a.products(slice(None), b, slice(None)) == whole).all()


def test_first_copies():
    ids, x = np.array([5, 3, 9, 3, 7]), np.array([[0.0], [-0.0], [0.0], [0.0], [1.0]])
    assert sorted(ids[tilejoin.first_copies(ids, x, 2)].tolist()) == [3, 5, 7]


def _negatives(rows, p, n, low, high):
    good = {(i, tuple(x), label) for i, x, label in rows if i is not None and label is not None and _good(x)}
    whole = {r: [math.floor(256 * c) for c in r[1]] for r in good}
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    out = []
    for a in good:
        if a[0] % 10:
            continue
        scored = [(-sum(u * v for u, v in zip(whole[a], whole[b])), b[0], b[2] == a[2]) for b in good if b[0] != a[0] and len(b[1]) == len(a[1])]
        for s, i in sorted({x[:2] for x in scored if x[2]})[:p]:
            s = clip(-s)
            fit = sorted({x[:2] for x in scored if not x[2] and low * s <= -100 * x[0] <= high * s})
            out += [(a[0], i, r + 1, j, s, clip(-t)) for r, (t, j) in enumerate(fit[:n])]
    return sorted(out)


def test_hard_negatives(table, rows, sizes, monkeypatch):
    monkeypatch.setattr(rtree, "LEAF", 4)
    monkeypatch.setattr(rtree, "FANOUT", 3)
    got = rtree.hard_negatives(table, asks(), positives=3, negatives=4)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == _negatives(rows, 3, 4, 30, 90)


def test_tree_prunes_and_bounds():
    """Boxes hold their rows, intervals hold their scores, and clustered rows leave most boxes closed."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-400, 400, (20, 5)).astype(float)
    x = centres[np.arange(4000) % 20] + rng.integers(-9, 9, (4000, 5))
    tree = rtree.Tree(np.arange(4000), np.arange(4000) % 2, x, x)
    anchor = x[0]
    low, high = tree.interval(np.arange(tree.leaves), np.maximum(anchor, 0), np.minimum(anchor, 0))
    for k in range(tree.leaves):
        scores = tree.x[tree.begin[k] : tree.end[k]] @ anchor
        assert low[k] <= scores.min() and scores.max() <= high[k]
        assert tree.end[k] - tree.begin[k] <= rtree.LEAF
    opened = []
    answers = rtree.Answers(5, [(-np.inf, np.inf)])
    take = answers.take
    answers.take = lambda scores, ids: (opened.append(len(ids)), take(scores, ids))
    answers.search(tree, tree.roots, anchor, 0)
    order = np.lexsort((np.arange(1, 4000), -(x[1:] @ anchor)))[:5] + 1
    assert sorted(answers.heaps[0], reverse=True) == [(int(x[i] @ anchor), -int(i)) for i in order]
    assert len(opened) < tree.leaves / 3


def test_empty(spark, table):
    none = table.where("false")
    assert tilejoin.nearest(none, asks()).count() == 0
    assert rtree.hard_negatives(none, asks()).count() == 0
    assert tilejoin.nearest(table, F.lit(None).cast("boolean")).count() == 0
