"""Layers by period: only touched periods are recomputed, folders by period and region."""

from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from sheafwork.operators.dedup import keep_one
from sheafwork.plans import orders
from sheafwork.plans.periods import PERIOD, PeriodFlow, PeriodTable, period_of
from sheafwork.queries import REGISTRY
from sheafwork.queries.orders import landing
from sheafwork.streaming import io
from tests.conftest import rows

SCHEMA = "id string, region string, amount string, moment string, seen int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_touched_days_are_recomputed(spark, tmp_path):  # PIP-24, PIP-25
    root = str(tmp_path / "flow")
    flow, cleaned = PeriodFlow(spark, root), []
    silver, gold = PeriodTable(spark, f"{root}/silver", ["region"]), PeriodTable(spark, f"{root}/gold")

    def clean(bronze):
        cleaned.append({r[0] for r in bronze.select(PERIOD).distinct().collect()})
        typed = bronze.withColumn("amount", F.col("amount").try_cast("long")).where("amount > 0")
        return keep_one(typed, ["id"], [F.col("seen")], "first").drop("seen")

    def deliver(n, batch):
        (tmp_path / "in").mkdir(exist_ok=True)
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
        flow.bronze(io.file_stream(spark, str(tmp_path / "in" / "*"), SCHEMA), "moment", str(tmp_path / "cp"))
        return flow.refresh(clean, silver, gold, lambda s: s.groupBy(PERIOD, "region").agg(F.sum("amount").alias("total")))

    day = lambda n: dt.date(2024, 1, n)
    assert deliver(1, [("a", "n", "5", "2024-01-01 10:00:00", 1), ("b", "s", "7", "2024-01-02 10:00:00", 1), ("x", "s", "7", "no time", 1)]) == [day(1), day(2)]
    # A copy and a new region for day 2, a first row for day 3, a bad amount: day 1 stays closed.
    second = [("b", "n", "9", "2024-01-02 11:00:00", 2), ("c", "w", "1", "2024-01-02 12:00:00", 2), ("d", "n", "2", "2024-01-03", 2), ("e", "n", "bad", "2024-01-03", 2)]
    assert deliver(2, second) == [day(2), day(3)]
    assert cleaned == [{day(1), day(2)}, {day(2), day(3)}]
    assert rows(gold.read(), PERIOD, "region", "total") == [(day(1), "n", 5), (day(2), "s", 7), (day(2), "w", 1), (day(3), "n", 2)]
    # An earlier copy moves an order to another region: its old folder is no longer read.
    assert deliver(3, [("b", "e", "3", "2024-01-02 09:00:00", 0)]) == [day(2)]
    assert rows(silver.read(), "id", "region", "amount") == [("a", "n", 5), ("b", "e", 3), ("c", "w", 1), ("d", "n", 2)]
    assert flow.refresh(clean, silver, gold, None) == [] and len(cleaned) == 3
    assert {d for d in os.listdir(f"{root}/bronze") if d.startswith(PERIOD)} == {f"{PERIOD}=2024-01-0{k}" for k in (1, 2, 3)} | {f"{PERIOD}=__HIVE_DEFAULT_PARTITION__"}
    assert sorted(d for d in os.listdir(f"{root}/silver/rows/_run=2/{PERIOD}=2024-01-02") if "=" in d) == ["region=s", "region=w"]


def test_bronze_of_few_periods_is_not_shuffled(spark, tmp_path):  # PIP-25
    """Each task writes rows of long periods where they are; those of short ones are gathered first."""
    moments = [f"2024-{1 + i % 3:02d}-01 10:00:00" for i in range(40)] + [None, "bad"]
    landed = spark.createDataFrame([(str(i), "n", "5", m, i) for i, m in enumerate(moments)], SCHEMA).repartition(4)
    landed.write.parquet(str(tmp_path / "in"))

    def bronze(unit):
        flow = PeriodFlow(spark, str(tmp_path / unit), unit)
        spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
        try:
            flow.bronze(io.file_stream(spark, str(tmp_path / "in"), SCHEMA), "moment", str(tmp_path / f"cp_{unit}"))
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = spark.read.parquet(f"{flow.root}/bronze")
        noted = spark.read.schema(f"{PERIOD} date").parquet(f"{flow.root}/touched")
        return rows(got, "id", PERIOD), got.select("_metadata.file_path").distinct().count(), rows(noted, PERIOD)

    by_month, n_month, noted = bronze("month")
    by_day, n_day, noted_days = bronze("day")
    months = [(dt.date(2024, k, 1),) for k in (1, 2, 3)]
    assert by_month == by_day and len(by_day) == 42 and noted == noted_days == sorted([*months, (None,)], key=repr)
    assert n_day == 4 < n_month


def test_silver_shuffles_no_derived_columns(spark):  # PIP-25
    raw = spark.createDataFrame(
        [("1-1", "7", "3", "2", "1.50", "2024-01-01 10:00:00", 1), ("1-1", "7", "3", "9", "1.50", "2024-01-01 10:00:00", 2), ("2-1", "8", "4", "x", "1.00", None, 1)],
        "order_id string, customer_id string, product_id string, qty string, unit_price string, event_time string, _ingested_at int",
    )
    products = spark.createDataFrame([("3", "nail")], "product_id string, product_name string")
    customers = spark.createDataFrame([("7", "ann")], "customer_id string, customer_name string")
    silver = orders.silver_sales(raw, products, customers)
    got = rows(silver, "order_id", "qty", "order_date", F.col("total_amount").cast("string").alias("total_amount"), "product_name", "customer_name")
    assert got == [("1-1", 2, dt.date(2024, 1, 1), "3.00", "nail", "ann"), ("2-1", None, None, None, None, None)]
    window = next(p for p in silver._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [row_number" in p)
    assert "qty" in window and "total_amount" not in window and "order_date" not in window


def test_tasks_that_count_buyers_follow_the_rows(spark, monkeypatch):  # PIP-25, AGG-24
    day, kind, buyer = F.col("id") % 7, F.when(F.col("id") % 5 > 0, F.col("id") % 3), F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(1))
    order_id, amount = F.when(F.col("id") % 13 > 0, F.col("id").cast("string")), F.when(F.col("id") % 17 > 0, F.col("id").cast("decimal(18,2)"))
    silver = spark.range(2000).select(order_id.alias("order_id"), day.alias("day"), kind.alias("kind"), buyer.alias("buyer"), amount.alias("amount"))
    monkeypatch.setattr(orders, "ROWS_PER_TASK", 100, raising=False)
    got = orders.daily_revenue(silver, ["day", "kind"], "amount", "buyer", 2000)
    assert re.search(r"hashpartitioning\(day#\d+L?, kind#\d+L?, buyer#\d+L?, 20\), REPARTITION_BY_NUM", plan(got))
    assert rows(got) == rows(orders.daily_revenue(silver, ["day", "kind"], "amount", "buyer"))


def test_tasks_of_daily_sales_follow_the_lines(spark, monkeypatch):  # PIP-25, AGG-24
    sf = "/root/testdata/sf0.001"
    run = REGISTRY["sales_daily_revenue"].run
    plain = rows(run(spark, sf))
    tasks = -(-spark.read.parquet(f"{sf}/lineitem.parquet").count() // 100)
    for limit in ("ROWS_PER_TASK", "LINES_PER_TASK"):
        monkeypatch.setattr(orders, limit, 100, raising=False)
    got = run(spark, sf)
    dealt = re.findall(r"hashpartitioning\((.*), (\d+)\), REPARTITION_BY_NUM", plan(got))
    assert [(re.sub(r"#\d+L?", "", keys), int(n)) for keys, n in dealt] == [
        ("order_date, category, region, customer_id", tasks), ("l_orderkey", tasks),
    ]
    assert rows(got) == plain


def test_deliveries_are_written_once(spark):  # PIP-24, PIP-25
    raw = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, t string")
    first, second = (spark.read.schema(raw.schema).parquet(f) for f in landing(raw, F.col("t") >= "b", "two"))
    assert rows(first) == [(1, "a"), (2, None)] and rows(second) == [(3, "b")]


def test_periods(spark):
    got = spark.createDataFrame([("2024-03-05 10:00:00",), ("bad",), (None,)], "t string").select(period_of(F.col("t"), "month").alias("p"))
    assert [r.p for r in got.collect()] == [dt.date(2024, 3, 1), None, None]
