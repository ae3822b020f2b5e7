"""Plans: pushdown, pruning, join choice, no cross joins and no single-task windows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sheafwork import workspace
from sheafwork.operators import windows
from sheafwork.queries import REGISTRY, panel, table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark):
    text = formatted(entry.queries()["filter_predicates"](spark, SF))
    assert "PushedFilters: [Or(" in text
    schema = re.search(r"ReadSchema: (\S+)", text)[1]
    assert "o_orderdate" not in schema and "o_custkey" not in schema


def test_market_share_reads_few_columns(spark):
    text = formatted(panel.shares(spark, SF))
    read = {m for m in re.findall(r"ReadSchema: struct<([^>]*)>", text)}
    lines = next(r for r in read if "l_orderkey" in r)
    assert sorted(c.split(":")[0] for c in lines.split(",")) == ["l_orderkey", "l_partkey", "l_quantity"]
    assert "Python" not in text


def test_file_listing_does_not_read_content(spark, tmp_path):
    from sheafwork.sources import landing

    (tmp_path / "a.bin").write_text("x")
    schema = re.search(r"ReadSchema: (\S+)", formatted(landing.list_files(spark, str(tmp_path))))[1]
    assert "content" not in schema


def test_partition_pruning(spark):
    nations = table(spark, SF, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    stored = workspace.stage(nations, "pruned", ["nationkey"])
    text = formatted(stored.filter("nationkey = 3"))
    assert re.search(r"PartitionFilters: \[isnotnull\(nationkey#\d+\), \(nationkey#\d+ = 3\)\]", text)


def test_dimension_filter_prunes_at_run_time(spark):
    assert "dynamicpruning" in plan(entry.queries()["join_pruned"](spark, SF))


@pytest.mark.parametrize(
    "name, node",
    [("join_merge_hint", "SortMergeJoin"), ("join_hash_hint", "ShuffledHashJoin"), ("join_broadcast", "BroadcastHashJoin"),
     ("join_range", "BroadcastHashJoin"), ("sort_limit", "TakeOrderedAndProject"), ("top1_per_group", "WindowGroupLimit"),
     ("topn_per_group", "WindowGroupLimit"), ("dedup_latest", "WindowGroupLimit")],
)
def test_physical_choice(spark, name, node):
    assert node in plan(entry.queries()[name](spark, SF))


# Queries that only build a plan (no staging or streaming) are cheap to look at.
PLANNED = [
    n for n in sorted(REGISTRY)
    if not n.startswith(("stream_", "pandas_")) and n not in ("staged_run", "table_writes")
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(REGISTRY[name].run(spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # A window without partition columns needs everything in one task. Only the
    # per-slice summaries (columns _slice, _n, _s ...) may do that.
    for line in re.findall(r"Window \[.*", text):
        unpartitioned = re.search(r"windowspecdefinition\((?=\w+#\d+L? (?:ASC|DESC))", line)
        assert unpartitioned is None or "_slice" in line, line


def test_rank_of_whole_table_is_split(spark):
    orders = table(spark, SF, "orders").select("o_orderkey", "o_totalprice")
    got = windows.OrderedSlices.build(orders, [], "o_totalprice", ["o_orderkey"], slices=6)
    assert got.staged.select("_slice").distinct().count() == 6
    sizes = [r.n for r in got.staged.groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2.5 * min(sizes)


def test_one_shuffle_for_wide_categories(spark):
    from sheafwork.plans.panel import REGISTRATION_COLUMNS, wide_categories

    rows = spark.createDataFrame([("a", 1, "ICE", 1.0)], "country_code string, year int, fuel_category string, v double")
    assert plan(wide_categories(rows, "v", REGISTRATION_COLUMNS)).count("Exchange") == 1
