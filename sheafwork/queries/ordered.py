"""Window and ranking queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheafwork.operators import windows
from sheafwork.queries.registry import big, money, query, real, table


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")


@query("win_rank", "WIN-01..03", """
SELECT c_custkey, c_mktsegment, c_acctbal,
       row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS row_number,
       rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC NULLS LAST) AS rank,
       dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC NULLS LAST) AS dense_rank FROM customer""")
def win_rank(spark, sf):
    return windows.ranked(_customers(spark, sf), ["c_mktsegment"], "c_acctbal", ["c_custkey"], descending=True)


@query("win_rank_ties", "WIN-01..03", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_returnflag, l_quantity,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rank,
       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS dense_rank FROM lineitem""")
def win_rank_ties(spark, sf):
    """Three groups with fifty order values: always ranked by slices."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_returnflag", "l_quantity"
    )
    slices = windows.OrderedSlices.build(rows, ["l_returnflag"], "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey"])
    return slices.ranked().drop("row_number")


@query("win_global_rank", "WIN-13", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_number,
       rank() OVER (ORDER BY o_totalprice DESC) AS rank, dense_rank() OVER (ORDER BY o_totalprice DESC) AS dense_rank FROM orders""")
def win_global_rank(spark, sf):
    """A rank over the whole table without moving the table to one task."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    slices = windows.OrderedSlices.build(rows, [], "o_totalprice", ["o_orderkey"], descending=True)
    return slices.ranked().drop("o_totalprice")


@query("win_ntile", "WIN-04 WIN-05", """
SELECT c_custkey, percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS percent_rank,
       ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS quartile FROM customer""")
def win_ntile(spark, sf):
    keys = ["c_mktsegment"]
    ranks = windows.ranked(_customers(spark, sf), keys, "c_acctbal", ["c_custkey"])
    sized = windows.with_group_stats(ranks, keys, [F.count(F.lit(1)).alias("n")])
    return sized.select(
        "c_custkey",
        windows.percent_rank(F.col("rank"), F.col("n")).alias("percent_rank"),
        windows.ntile(F.col("row_number"), F.col("n"), 4).alias("quartile"),
    )


@query("win_lag_lead", "WIN-06 WIN-07", """
SELECT o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS following
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def win_lag_lead(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = windows.neighbours(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], "o_orderkey", "previous", "following")
    return out.select("o_orderkey", "previous", "following")


@query("win_lag_default", "WIN-06 WIN-17", """
WITH d AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
           FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, day, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue - lag(revenue, 1, 0) OVER (PARTITION BY o_orderstatus ORDER BY day) AS DOUBLE) AS delta FROM d""")
def win_lag_default(spark, sf):
    daily = table(spark, sf, "orders").groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day")).agg(
        F.sum(money("o_totalprice")).alias("revenue")
    )
    w = Window.partitionBy("o_orderstatus").orderBy("day")
    before = F.coalesce(F.lag("revenue", 1).over(w), F.lit(0))
    return daily.select("o_orderstatus", "day", real("revenue").alias("revenue"), real(F.col("revenue") - before).alias("delta"))


@query("win_running", "WIN-08", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM orders""")
def win_running(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("price"))
    out = windows.running_sum(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], "price", "running_total")
    return out.select("o_orderkey", real("running_total").alias("running_total"))


@query("win_running_global", "WIN-08 WIN-13", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey
       ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM orders""")
def win_running_global(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", money("o_totalprice").alias("price"))
    slices = windows.OrderedSlices.build(orders, [], "o_orderdate", ["o_orderkey"])
    return slices.running_sum("price", "running_total").select("o_orderkey", real("running_total").alias("running_total"))


_DAILY = """d AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) AS n
  FROM events GROUP BY 1, 2)"""


def _daily_events(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum(money("value")).alias("total"), F.count(F.lit(1)).alias("n")
    )


@query("win_moving", "WIN-09", f"""WITH {_DAILY}
SELECT event_type, day,
       CAST(sum(total) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS DOUBLE)
         / count(*) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS centred,
       CAST(sum(total) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / count(*) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS trailing FROM d""")
def win_moving(spark, sf):
    series = Window.partitionBy("event_type").orderBy("day")

    def mean(frame):
        return real(F.sum("total").over(frame)) / F.count(F.lit(1)).over(frame)

    return _daily_events(spark, sf).select(
        "event_type", "day", mean(series.rowsBetween(-1, 1)).alias("centred"), mean(series.rowsBetween(-2, 0)).alias("trailing")
    )


@query("win_moving_raw", "WIN-09", """
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS DOUBLE)
         / count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS centred
FROM events""")
def win_moving_raw(spark, sf):
    """Centred mean over the raw events of five types, each in blocks."""
    rows = table(spark, sf, "events").select("event_id", "event_type", "ts", money("value").alias("value"))
    mean = {"total": lambda w: F.sum("value").over(w), "n": lambda w: F.count(F.lit(1)).over(w)}
    out = windows.framed(rows, ["event_type"], "ts", ["event_id"], 1, 1, mean)
    return out.select("event_id", (real("total") / F.col("n")).alias("centred"))


@query("win_range_raw", "WIN-12", """
WITH s AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS second, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2)
SELECT event_type, second, CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(total) OVER w AS DOUBLE) AS total
FROM s WINDOW w AS (PARTITION BY event_type ORDER BY second RANGE BETWEEN 604799 PRECEDING AND CURRENT ROW)""")
def win_range_raw(spark, sf):
    """Events and value of the seven days up to each second of the raw events."""
    rows = table(spark, sf, "events")
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    out = windows.range_totals(rows, ["event_type"], second, 7 * 86400 - 1, 0, {"n": F.lit(1), "total": money("value")}, "second")
    return out.withColumn("total", real("total"))


@query("win_partition_agg", "WIN-10", """
SELECT c_custkey, min(c_acctbal) OVER w AS lowest, max(c_acctbal) OVER w AS highest, count(*) OVER w AS n,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) - max(CAST(c_acctbal AS DECIMAL(18,2))) OVER w AS DOUBLE) AS gap
FROM customer WINDOW w AS (PARTITION BY c_nationkey)""")
def win_partition_agg(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out = windows.with_group_stats(
        rows, ["c_nationkey"],
        [F.min("c_acctbal").alias("lowest"), F.max("c_acctbal").alias("highest"), F.count(F.lit(1)).alias("n")],
    )
    return out.select(
        "c_custkey", "lowest", "highest", "n", real(money("c_acctbal") - money("highest")).alias("gap")
    )


@query("win_first_last", "WIN-11", """
SELECT o_orderkey, first_value(o_orderkey) OVER w AS first_order, last_value(o_orderkey) OVER w AS last_order
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def win_first_last(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    order = F.struct("o_orderdate", "o_orderkey")
    ends = windows.with_group_stats(
        orders, ["o_custkey"],
        [F.min_by("o_orderkey", order).alias("first_order"), F.max_by("o_orderkey", order).alias("last_order")],
    )
    return ends.select("o_orderkey", "first_order", "last_order")


@query("win_range", "WIN-12", f"""WITH {_DAILY}
SELECT event_type, day, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day
       RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS week_events FROM d""")
def win_range(spark, sf):
    """Events of the last seven calendar days: a value range, so missing days count as empty."""
    week = Window.partitionBy("event_type").orderBy(F.unix_date("day")).rangeBetween(-6, 0)
    return _daily_events(spark, sf).select("event_type", "day", F.sum("n").over(week).alias("week_events"))


@query("topn_per_group", "WIN-14", """
SELECT c_custkey, c_mktsegment, c_acctbal, rnk FROM (SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS rnk
FROM customer) WHERE rnk <= 3""")
def topn_per_group(spark, sf):
    top = windows.top_n_values(_customers(spark, sf), ["c_mktsegment"], "c_acctbal", 3)
    return top.withColumn("rnk", big("rnk"))


@query("top1_per_group", "WIN-15", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
ORDER BY o_totalprice DESC, o_orderkey) AS rnk FROM orders) WHERE rnk = 1""")
def top1_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_n(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 1).drop("rnk")
