"""Aggregation and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import joins, reshape, skew
from sheafwork.queries.registry import big, money, query, real, table


def lines(spark, sf, *cols):
    return table(spark, sf, "lineitem").select(*cols)


@query("agg_multi", "AGG-01 AGG-05", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS sum_disc_price,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_qty,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY 1, 2""")
def agg_multi(spark, sf):
    price, qty = money("l_extendedprice"), money("l_quantity")
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            real(F.sum(qty)).alias("sum_qty"),
            real(F.sum(price)).alias("sum_price"),
            real(F.sum(price * (1 - F.col("l_discount").cast("decimal(4,2)")))).alias("sum_disc_price"),
            (real(F.sum(qty)) / F.count(F.lit(1))).alias("avg_qty"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )


@query("agg_two_keys", "AGG-02", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2""")
def agg_two_keys(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), real(F.sum(money("o_totalprice"))).alias("total")
    )


@query("agg_global", "AGG-03 AGG-04 AGG-05", """
SELECT count(*) AS n, count(CASE WHEN l_discount > 0 THEN 1 END) AS discounted, min(l_orderkey) AS first_key,
       max(l_orderkey) AS last_key, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
       strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship FROM lineitem""")
def agg_global(spark, sf):
    discounted = F.when(F.col("l_discount") > 0, 1)  # null otherwise, so count skips it
    return table(spark, sf, "lineitem").agg(
        F.count("*").alias("n"), F.count(discounted).alias("discounted"),
        F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key"),
        real(F.sum(money("l_quantity"))).alias("qty"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_ship"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_ship"),
    )


@query("agg_distinct", "AGG-06", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_partkey, l_suppkey)) AS pairs
FROM lineitem GROUP BY 1""")
def agg_distinct(spark, sf):
    return lines(spark, sf, "l_returnflag", "l_partkey", "l_suppkey").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey", "l_suppkey").alias("pairs")
    )


@query("approx_distinct", "AGG-07")
def approx_distinct(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.02).alias("approx_users")
    )


@query("approx_distinct_error", "AGG-07",
       "SELECT event_type, count(DISTINCT user_id) AS users, true AS within_bound FROM events GROUP BY 1")
def approx_distinct_error(spark, sf):
    """The estimate against the exact count, as a check of the error bound (four deviations)."""
    rsd = 0.02
    by_type = table(spark, sf, "events").groupBy("event_type")
    # Apart: beside a distinct count, Spark keeps a sketch of some kilobytes for every type and user.
    approx = by_type.agg(F.approx_count_distinct("user_id", rsd).alias("approx"))
    exact = by_type.agg(F.count_distinct("user_id").alias("users"))
    both = joins.null_safe_join(exact, approx, ["event_type"])
    error = F.abs(F.col("approx") - F.col("users"))
    return both.select("event_type", "users", (error <= 4 * rsd * F.col("users")).alias("within_bound"))


@query("agg_stats", "AGG-08", """
WITH a AS (SELECT c_mktsegment, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS s,
                  sum(CAST(c_acctbal AS DECIMAL(18,2)) * CAST(c_acctbal AS DECIMAL(18,2))) AS q FROM customer GROUP BY 1),
v AS (SELECT c_mktsegment, n, (CAST(q AS DOUBLE) - CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / n) / (n - 1) AS var FROM a)
SELECT c_mktsegment, n, CAST(round(var / 1000) AS BIGINT) AS variance_k, CAST(round(sqrt(var)) AS BIGINT) AS stddev FROM v""")
def agg_stats(spark, sf):
    """Sample variance and deviation; rounded, because summation order moves the last digits."""
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        big(F.round(F.var_samp("c_acctbal") / 1000)).alias("variance_k"),
        big(F.round(F.stddev_samp("c_acctbal"))).alias("stddev"),
    )


@query("agg_first_last", "AGG-09", """
SELECT o_custkey, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
       max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1""")
def agg_first_last(spark, sf):
    order = F.struct("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", order).alias("first_order"), F.max_by("o_orderkey", order).alias("last_order")
    )


@query("agg_collect", "AGG-10 COL-12", """
SELECT l_orderkey, CAST(0 AS BIGINT) AS chunk, count(*) AS n,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts FROM lineitem GROUP BY 1""")
def agg_collect(spark, sf):
    """Part keys per order as sorted arrays; an order too big for one array is cut into chunks."""
    rows = lines(spark, sf, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    chunks = reshape.collect_chunks(
        rows, ["l_orderkey"], F.col("l_partkey"), ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    )
    return chunks.select(
        "l_orderkey", big("chunk").alias("chunk"), big(F.size("items")).alias("n"),
        F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("parts"),
    )


@query("agg_collect_set", "AGG-10 AGG-11", """
SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types, count(DISTINCT p_type) AS n_types FROM part GROUP BY 1""")
def agg_collect_set(spark, sf):
    """Sets and joined lists over a small domain: duplicates fall away on the map side."""
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"),
        big(F.size(F.collect_set("p_type"))).alias("n_types"),
    )


@query("agg_listagg", "AGG-11", """
SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def agg_listagg(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = nations.select("r_name", "n_name").distinct()
    return names.groupBy("r_name").agg(F.concat_ws(", ", F.array_sort(F.collect_list("n_name"))).alias("nations"))


@query("agg_having", "AGG-12 AGG-13", """
SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem
WHERE l_discount > 0.03 GROUP BY 1 HAVING count(*) > 380 AND sum(CAST(l_quantity AS DECIMAL(18,2))) > 9000""")
def agg_having(spark, sf):
    return (
        table(spark, sf, "lineitem").filter(F.col("l_discount") > 0.03).groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("n"), real(F.sum(money("l_quantity"))).alias("qty"))
        .filter((F.col("n") > 380) & (F.col("qty") > 9000))
    )


@query("agg_having_sql", "AGG-12 SRC-08 SRC-16", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 15""")
def agg_having_sql(spark, sf):
    """The SQL form, with a bound parameter instead of text substitution."""
    return spark.sql(
        "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) >= :least",
        args={"least": 15}, orders=table(spark, sf, "orders"),
    )


@query("pivot_basic", "AGG-14", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
       count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def pivot_basic(spark, sf):
    return reshape.pivot(
        table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], [F.count(F.lit(1))]
    )


@query("pivot_multi", "AGG-15", """
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'O') AS DOUBLE) AS "O_sum",
       count(*) FILTER (l_linestatus = 'O') AS "O_n",
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'F') AS DOUBLE) AS "F_sum",
       count(*) FILTER (l_linestatus = 'F') AS "F_n" FROM lineitem GROUP BY 1""")
def pivot_multi(spark, sf):
    return reshape.pivot(
        table(spark, sf, "lineitem"), ["l_returnflag"], "l_linestatus", ["O", "F"],
        [real(F.sum(money("l_quantity"))).alias("sum"), F.count(F.lit(1)).alias("n")],
    )


@query("pivot_zero_fill", "AGG-16", """
SELECT user_id, count(*) FILTER (event_type = 'view') AS "view", count(*) FILTER (event_type = 'click') AS click,
       count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'purchase') AS purchase,
       count(*) FILTER (event_type = 'error') AS error FROM events GROUP BY 1""")
def pivot_zero_fill(spark, sf):
    wide = reshape.pivot(
        table(spark, sf, "events"), ["user_id"], "event_type", ["view", "click", "signup", "purchase", "error"], [F.count(F.lit(1))]
    )
    return wide.na.fill(0)


@query("pivot_sql", "AGG-17", """
SELECT c_nationkey::BIGINT AS nationkey, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS automobile,
       count(*) FILTER (c_mktsegment = 'BUILDING') AS building, count(*) FILTER (c_mktsegment = 'FURNITURE') AS furniture,
       count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS household, count(*) FILTER (c_mktsegment = 'MACHINERY') AS machinery FROM customer GROUP BY 1""")
def pivot_sql(spark, sf):
    return spark.sql(
        """SELECT CAST(nationkey AS BIGINT) AS nationkey, coalesce(automobile, 0) AS automobile, coalesce(building, 0) AS building,
                  coalesce(furniture, 0) AS furniture, coalesce(household, 0) AS household, coalesce(machinery, 0) AS machinery
           FROM (SELECT c_nationkey AS nationkey, c_mktsegment FROM {customer})
           PIVOT (count(*) FOR c_mktsegment IN ('AUTOMOBILE' AS automobile, 'BUILDING' AS building, 'FURNITURE' AS furniture,
                                                'HOUSEHOLD' AS household, 'MACHINERY' AS machinery))""",
        customer=table(spark, sf, "customer"),
    )


@query("unpivot", "AGG-18", """
SELECT o_orderkey, 'custkey' AS field, o_custkey AS amount FROM orders
UNION ALL SELECT o_orderkey, 'cents', CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) FROM orders""")
def unpivot(spark, sf):
    wide = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), big(money("o_totalprice") * 100).alias("cents")
    )
    return reshape.unpivot(wide, ["o_orderkey"], ["custkey", "cents"], "field", "amount")


@query("summary_stats", "AGG-19", """
WITH a AS (SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem UNION ALL SELECT 'l_linenumber', l_linenumber FROM lineitem)
SELECT "column", count(v) AS "count", CAST(sum(CAST(v AS BIGINT)) AS DOUBLE) / count(v) AS mean, min(v) AS min, max(v) AS max,
       CAST(round(stddev_samp(v) * 1000000) AS BIGINT) AS stddev_micro, true AS quartiles_ok FROM a GROUP BY 1""")
def summary_stats(spark, sf):
    """Summary of two columns; the approximate quartiles are checked by their rank error."""
    columns, accuracy = ["l_quantity", "l_linenumber"], 10_000
    whole = lines(spark, sf, *columns)
    stats = workspace.stage(reshape.summary(whole, columns, accuracy), "summary")
    checks = []
    for row in stats.collect():  # one row per column
        v = F.col(row["column"])
        for share, point in ((0.25, row["p25"]), (0.5, row["p50"]), (0.75, row["p75"])):
            below, upto = F.count_if(v < point), F.count_if(v <= point)
            n, slack = F.count(v), 2 / accuracy
            checks.append(((below <= (share + slack) * n) & (upto >= (share - slack) * n)).alias(f"ok_{len(checks)}"))
    passed = whole.agg(*checks).select(F.forall(F.array([f"ok_{i}" for i in range(len(checks))]), lambda x: x)).scalar()
    return stats.select(
        "column", "count", "mean", "min", "max", big(F.round(F.col("stddev") * 1000000)).alias("stddev_micro"),
        passed.alias("quartiles_ok"),
    )


@query("frequency", "AGG-20", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def frequency(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "event_type")


@query("agg_salted", "AGG-21", """
SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1""")
def agg_salted(spark, sf):
    rows = lines(spark, sf, "l_suppkey", "l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"))
    return skew.salted_aggregate(
        rows, ["l_suppkey"], ["l_orderkey", "l_linenumber"],
        partial=[F.count(F.lit(1)).alias("_n"), F.sum("price").alias("_s")],
        final=[F.sum("_n").alias("n"), real(F.sum("_s")).alias("revenue")],
    )


@query("agg_weighted", "AGG-22", """
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE)
       / CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS weighted_discount FROM lineitem GROUP BY 1""")
def agg_weighted(spark, sf):
    price, discount = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.try_divide(real(F.sum(price * discount)), real(F.sum(price))).alias("weighted_discount")
    )


@query("agg_reagg", "AGG-23", """
WITH d AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
           FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, count(*) AS days, CAST(sum(revenue) AS DOUBLE) AS total, CAST(max(revenue) AS DOUBLE) AS best_day FROM d GROUP BY 1""")
def agg_reagg(spark, sf):
    daily = table(spark, sf, "orders").groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day")).agg(
        F.sum(money("o_totalprice")).alias("revenue")
    )
    return daily.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("days"), real(F.sum("revenue")).alias("total"), real(F.max("revenue")).alias("best_day")
    )


@query("agg_entity_mix", "AGG-24", """
SELECT c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS buyers, count(DISTINCT o_orderpriority) AS priorities,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def agg_entity_mix(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("buyers"),
        F.count_distinct("o_orderpriority").alias("priorities"), real(F.sum(money("o_totalprice"))).alias("value"),
    )
