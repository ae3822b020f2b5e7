"""Splitting of hot groups: same answers as the plain forms and as brute force."""

from __future__ import annotations

import random
import re

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sheafwork.operators import reshape, skew, windows
from tests.conftest import rows


def hot_rows(seed=1, n=400):
    """About a third of the rows share one key; order values repeat and include nulls."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice("abcdefgh")
        value = None if rnd.random() < 0.05 else (7 if rnd.random() < 0.3 else rnd.randrange(30))
        out.append((i, key, value, rnd.randrange(1000)))
    return out


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(spark, request):
    raw = hot_rows(request.param)
    return spark.createDataFrame(raw, "id int, k string, v int, x int"), raw


def brute_ranks(raw, descending, grouped=True):
    expected = set()
    groups = {}
    for r in raw:
        groups.setdefault(r[1] if grouped else None, []).append(r)
    for members in groups.values():
        def place(r):
            return (r[2] is None, 0 if r[2] is None else (-r[2] if descending else r[2]))

        ordered = sorted(members, key=lambda r: (place(r), r[0]))
        dense, rank, last = 0, 0, object()
        for n, r in enumerate(ordered, 1):
            if place(r) != last:
                dense, rank, last = dense + 1, n, place(r)
            expected.add((r[0], n, rank, dense))
    return expected


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", [1, 5, 16])
def test_sliced_ranks_match_brute_force(data, descending, slices):
    df, raw = data
    got = windows.OrderedSlices.build(df, ["k"], "v", ["id"], descending, slices).ranked()
    assert {tuple(r) for r in got.select("id", "row_number", "rank", "dense_rank").collect()} == brute_ranks(raw, descending)


def test_sliced_ranks_without_keys(data):
    df, raw = data
    got = windows.OrderedSlices.build(df, [], "v", ["id"], True, 9).ranked()
    assert {tuple(r) for r in got.select("id", "row_number", "rank", "dense_rank").collect()} == brute_ranks(raw, True, False)


def test_slices_split_one_repeated_value(spark):
    """All rows tie: rank 1 for all, although the value spans several slices."""
    df = spark.range(200).select("id", F.lit("one").alias("k"), F.lit(5).alias("v"))
    got = windows.OrderedSlices.build(df, ["k"], "v", ["id"], slices=6)
    assert got.staged.select("_slice").distinct().count() > 1
    ranked = got.ranked()
    assert ranked.filter("rank <> 1 OR dense_rank <> 1").isEmpty()
    assert rows(ranked, "row_number") == sorted([(i,) for i in range(1, 201)], key=repr)


def test_ranked_takes_both_paths(data):
    df, _ = data
    cols = ["id", "row_number", "rank", "dense_rank"]
    native = windows.ranked(df, ["k"], "v", ["id"], True)
    split = windows.ranked(df, ["k"], "v", ["id"], True, limit=20)
    assert rows(native, *cols) == rows(split, *cols)


def test_running_sum_split(data):
    df, _ = data
    native = windows.running_sum(df, ["k"], "v", ["id"], "x", "total")
    split = windows.running_sum(df, ["k"], "v", ["id"], "x", "total", limit=20)
    assert rows(native, "id", "total") == rows(split, "id", "total")


def test_running_sum_has_one_type(data):
    exact = data[0].withColumn("x", F.col("x").cast("decimal(18,2)"))
    native = windows.running_sum(exact, ["k"], "v", ["id"], "x", "total")
    split = windows.running_sum(exact, ["k"], "v", ["id"], "x", "total", limit=20)
    assert native.schema["total"].dataType == split.schema["total"].dataType
    assert rows(native, "id", "total") == rows(split, "id", "total")


@pytest.mark.parametrize("descending", [False, True])
def test_neighbours_split(data, descending):
    df, _ = data
    order = [F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last(), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order)
    native = df.withColumns({"before": F.lag("x").over(w), "after": F.lead("x").over(w)})
    split = windows.OrderedSlices.build(df, ["k"], "v", ["id"], descending, 7).neighbours("x", "before", "after")
    assert rows(native, "id", "before", "after") == rows(split, "id", "before", "after")


def test_ntile_and_percent_rank(spark):
    for n in (1, 3, 4, 10, 11):
        df = spark.range(n).select(F.lit(1).alias("k"), "id")
        w = Window.partitionBy("k").orderBy("id")
        out = df.select(
            F.ntile(4).over(w).alias("a"), F.percent_rank().over(w).alias("b"), F.row_number().over(w).alias("r")
        ).select("a", "b", windows.ntile(F.col("r"), F.lit(n), 4).alias("c"), windows.percent_rank(F.col("r"), F.lit(n)).alias("d"))
        assert all(r.a == r.c and r.b == r.d for r in out.collect())


def test_split_hot_spreads_only_hot_keys(data):
    df, raw = data
    parts = skew.split_hot(df, ["k"], ["id"], limit=60)
    assert parts.count() == len(raw)
    per_key = {r.k: r.n for r in parts.groupBy("k").agg(F.count_distinct("_part").alias("n")).collect()}
    assert per_key.pop("hot") > 1
    assert set(per_key.values()) == {1}


def test_split_hot_null_keys(spark):
    df = spark.range(50).select("id", F.when(F.col("id") > 40, "a").alias("k"))
    parts = skew.split_hot(df, ["k"], ["id"], limit=10)
    assert parts.count() == 50
    assert parts.filter("k IS NULL").select("_part").distinct().count() > 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(data, spark, how):
    df, _ = data
    dim = spark.createDataFrame([(k, i) for i, k in enumerate(["hot", "a", "b", "z"])], "k string, d int")
    plain = df.join(dim, "k", how)
    salted = skew.salted_join(df, dim, "k", ["id"], how, limit=30)
    assert rows(plain, "id", "k", "d") == rows(salted, "id", "k", "d")


def test_salted_aggregate_keeps_keys_with_suffix(spark):
    df = spark.createDataFrame([("a_1", i) for i in range(50)] + [("a", 1), ("a_2", 5)], "k string, v int")
    out = skew.salted_aggregate(df, ["k"], ["v"], [F.sum("v").alias("s")], [F.sum("s").alias("s")], salts=4)
    assert rows(out) == [("a", 1), ("a_1", sum(range(50))), ("a_2", 5)]


def test_collect_chunks_is_whole(data):
    df, raw = data
    chunks = reshape.collect_chunks(df, ["k"], F.col("id"), ["id"], limit=40)
    sizes = {r.k: r.n for r in chunks.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert sizes["hot"] > 1
    joined = {}
    for r in sorted(chunks.collect(), key=lambda r: r.chunk):
        assert r.chunk == len(joined.get(r.k, [])) / 40
        joined.setdefault(r.k, []).extend(r["items"])
    assert all(v == sorted(v) for v in joined.values())
    flat = chunks.select("k", F.explode("items").alias("id"))
    assert rows(flat) == sorted([(r[1], r[0]) for r in raw], key=repr)


def test_collect_chunks_cuts_equal_rows(spark):
    same = spark.range(100).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    chunks = reshape.collect_chunks(same, ["k"], F.col("v"), ["v"], limit=10)
    assert rows(chunks.select("chunk", F.size("items"))) == [(i, 10) for i in range(10)]


def test_group_stats_match_window(data):
    df, _ = data
    joined = windows.with_group_stats(df, ["k"], [F.max("x").alias("m")])
    window = df.withColumn("m", F.max("x").over(Window.partitionBy("k")))
    assert rows(joined, "id", "m") == rows(window, "id", "m")


def test_top_values_keep_all_ties(data):
    df, raw = data
    got = {(r.id, r.rnk) for r in windows.top_n_values(df, ["k"], "v", 2).collect()}
    pdf = pd.DataFrame(raw, columns=["id", "k", "v", "x"]).dropna(subset=["v"])
    pdf["rnk"] = pdf.groupby("k")["v"].rank(method="dense", ascending=False).astype(int)
    assert got == {(r.id, r.rnk) for r in pdf[pdf.rnk <= 2].itertuples()}


@pytest.mark.parametrize("before, after, block", [(1, 1, 2), (3, 0, 3), (0, 4, 5), (2, 5, 50)])
def test_frames_over_blocks(data, before, after, block):  # WIN-09
    df, _ = data
    make = {"s": lambda w: F.sum("x").over(w), "n": lambda w: F.count("*").over(w), "top": lambda w: F.max("x").over(w)}
    got = windows.framed(df, ["k"], "v", ["id"], before, after, make, block, slices=5)
    plain = Window.partitionBy("k").orderBy(F.asc_nulls_last("v"), "id").rowsBetween(-before, after)
    assert rows(got) == rows(df.withColumns({n: f(plain) for n, f in make.items()}))


@pytest.mark.parametrize("before, after", [(6, 0), (2, 3), (0, 1), (0, 0)])
def test_range_totals(spark, before, after):  # WIN-12
    rng = random.Random(before)
    raw = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(-20, 25, 1 + rng.randrange(2))]), rng.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(raw, "k string, v long, x long")
    got = windows.range_totals(df, ["k"], F.col("v"), before, after, {"s": F.col("x"), "n": F.lit(1)})
    want = []
    for k, v in {(r[0], r[1]) for r in raw if r[1] is not None}:
        near = [r[2] for r in raw if r[0] == k and r[1] is not None and v - before <= r[1] <= v + after]
        want.append((k, v, sum(near), len(near)))
    assert rows(got, "k", "at", "s", "n") == sorted(want, key=repr)


def test_range_totals_frames_only_grow(spark):  # WIN-12
    """Spark adds a moving frame up anew for each row; running sums take each row once. Null and infinite measures stay apart."""
    raw = [(v, {3: None, 4: None, 5: float("inf")}.get(v, float(v))) for v in range(12)]
    got = windows.range_totals(spark.createDataFrame(raw, "v long, x double"), [], F.col("v"), 1, 0, {"s": F.col("x")})
    frames = re.findall(r"specifiedwindowframe\((.*?),(.*?),", got._jdf.queryExecution().analyzed().toString())
    assert frames and all("unboundedpreceding" in start for _, start in frames)
    inf = float("inf")
    assert rows(got, "at", "s") == sorted(zip(range(12), [0.0, 1.0, 3.0, 2.0, None, inf, inf, 13.0, 15.0, 17.0, 19.0, 21.0]), key=repr)


@pytest.mark.parametrize("limit", [40, 100, 700, 5000])
def test_hot_keys_equal_the_exact_count(spark, limit):  # QLT-07
    """Null and two-column keys, more keys than the sketch has counters, over several tasks."""
    rng = random.Random(limit)
    raw = [(rng.choice(["a", None]), rng.randrange(3) if rng.random() < 0.5 else rng.randrange(2000)) for _ in range(6000)]
    df = spark.createDataFrame(raw, "k string, n int").repartition(7)
    counts = pd.Series(raw).value_counts()
    want = sorted([(*key, -(-c // limit)) for key, c in counts.items() if c > limit], key=repr)
    assert rows(skew.hot_keys(df, ["k", "n"], limit)) == want
    assert skew.hot_keys(df.limit(0), ["k", "n"], limit).count() == 0


def test_hot_keys_below_the_sketch(spark):  # QLT-07
    """A limit under 1e-4 of the rows, which Spark's sketch refuses."""
    df = spark.range(40_000).select(F.when(F.col("id") % 8000 == 0, "a").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    assert rows(skew.hot_keys(df, ["k"], 3)) == [("a", 2)]


def test_hot_keys_shuffle_few_rows(spark):  # QLT-07
    """The sketch is one row for each task; no plan shuffles the keys themselves."""
    df = spark.range(10_000).select((F.col("id") % 5000).alias("k"))
    text = skew.frequent_candidates(df, ["k"], 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and skew.frequent_candidates(df, ["k"], 0.1).count() <= 10
