"""Order ETL queries: raw strings to silver, revenue and customer value."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import quality
from sheafwork.plans import orders as jobs
from sheafwork.plans.periods import PERIOD, PeriodFlow, PeriodTable, period_of
from sheafwork.plans.run import Step, run_steps
from sheafwork.queries.registry import REGISTRY, big, money, query, real, table
from sheafwork.streaming import io

RAW_SQL = """
src AS (SELECT o.*, c_name, r_name FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
raw AS (
  SELECT CASE WHEN o_orderkey % 40 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 14 = 0 THEN ' 123 ' ELSE '  ' || c_name || ' ' END AS customer, ' ' || lower(o_orderpriority) AS category,
         CASE WHEN o_orderkey % 15 = 0 THEN 'INVALID' WHEN o_orderkey % 16 = 0 THEN '-5' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CAST(o_orderdate AS DATE) AS order_date, lower(r_name) AS region, 1 AS ingested FROM src
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), c_name, lower(o_orderpriority), '1.00', CAST(o_orderdate AS DATE), lower(r_name), 2
  FROM src WHERE o_orderkey % 12 = 0),
valid AS (
  SELECT order_id, customer_id, nullif(trim(regexp_replace(trim(customer), '[^a-zA-Z ]', '', 'g')), '') AS customer,
         upper(trim(category)) AS category, upper(trim(region)) AS region, TRY_CAST(amount AS DECIMAL(18,2)) AS amount, order_date, ingested FROM raw),
silver AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingested) AS rn FROM valid
  WHERE order_id IS NOT NULL AND customer IS NOT NULL AND amount > 0) WHERE rn = 1)
"""


def raw_orders(spark, sf):
    """Order rows as raw strings with missing ids, unreadable numbers and late duplicates."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    src = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key, text = F.col("o_orderkey"), "string"
    shared = {
        "customer_id": F.col("o_custkey").cast(text),
        "order_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "region": F.lower("r_name"),
    }
    first = src.select(
        F.when(key % 40 != 0, key.cast(text)).alias("order_id"),
        F.when(key % 14 == 0, " 123 ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("customer"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("category"),
        F.when(key % 15 == 0, "INVALID").when(key % 16 == 0, "-5").otherwise(money("o_totalprice").cast(text)).alias("amount"),
        *[e.alias(n) for n, e in shared.items()],
        F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
    )
    again = src.filter(key % 12 == 0).select(
        key.cast(text).alias("order_id"), F.col("c_name").alias("customer"), F.lower("o_orderpriority").alias("category"),
        F.lit("1.00").alias("amount"), *[e.alias(n) for n, e in shared.items()],
        F.lit("2024-01-02").cast("timestamp").alias("_ingested_at"),
    )
    return first.unionByName(again)


def silver(spark, sf):
    return jobs.silver_orders(jobs.bronze_orders(raw_orders(spark, sf)))


@query("orders_silver", "PIP-24 PRJ-22 STRF-13", f"""WITH {RAW_SQL}
SELECT order_id, customer_id, customer, category, region, CAST(amount AS DOUBLE) AS amount, order_date FROM silver""")
def orders_silver(spark, sf):
    return silver(spark, sf).withColumn("amount", real("amount"))


@query("daily_revenue", "PIP-24 AGG-24", f"""WITH {RAW_SQL}
SELECT order_date, region, category, count(order_id) AS order_count, CAST(sum(amount) AS DOUBLE) AS revenue,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_order_value FROM silver GROUP BY 1, 2, 3""")
def daily_revenue(spark, sf):
    out = jobs.daily_revenue(silver(spark, sf), ["order_date", "region", "category"], "amount")
    return out.withColumn("revenue", real("revenue"))


@query("customer_ltv", "PIP-24 AGG-24", f"""WITH {RAW_SQL}
SELECT customer_id, count(order_id) AS total_orders, CAST(sum(amount) AS DOUBLE) AS lifetime_value,
       count(DISTINCT category) AS categories_bought FROM silver GROUP BY 1""")
def customer_ltv(spark, sf):
    return jobs.customer_value(silver(spark, sf), ["customer_id"], "amount").withColumn("lifetime_value", real("lifetime_value"))


SALES_SQL = """
srow AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
            CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS BIGINT) AS qty,
            CASE WHEN (l_orderkey + l_linenumber) % 20 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS unit_price,
            CAST(o_orderdate AS DATE) AS order_date, l_shipdate AS ingested
     FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sone AS (SELECT *, qty * unit_price AS total_amount FROM (SELECT *, row_number() OVER (PARTITION BY order_id
     ORDER BY ingested, customer_id, product_id, qty, unit_price) AS rn FROM srow WHERE unit_price > 0) WHERE rn = 1),
sales AS (SELECT s.*, p_name AS product_name, p_type AS category, c_name AS customer_name, r_name AS region,
            CASE WHEN c_acctbal > 5000 THEN 'premium' ELSE 'standard' END AS tier
     FROM sone s LEFT JOIN part ON product_id = CAST(p_partkey AS VARCHAR) LEFT JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR)
     LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
"""


def raw_sales(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # This join and the map side of the de-duplication after it sort in one task, so lines are dealt by their
    # number. No order fills a task. Few lines are left to Spark, which may send the orders to them.
    tasks = -(-lines.count() // jobs.LINES_PER_TASK)
    if tasks > spark.sparkContext.defaultParallelism:
        lines = lines.repartition(tasks, "l_orderkey")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    spoiled = (F.col("l_orderkey") + F.col("l_linenumber")) % 20 == 0
    return both.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"), F.col("l_partkey").cast("string").alias("product_id"),
        big("l_quantity").cast("string").alias("qty"),
        F.when(spoiled, "BAD").otherwise(money("l_extendedprice").cast("string")).alias("unit_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.col("l_shipdate").alias("_ingested_at"),
    )


def dimensions(spark, sf):
    products = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")
    )
    geo = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("r_name").alias("region"), F.when(F.col("c_acctbal") > 5000, "premium").otherwise("standard").alias("tier"),
    )
    return products, customers


def sales(spark, sf):
    return jobs.silver_sales(raw_sales(spark, sf), *dimensions(spark, sf))


def landing(raw, late, name):
    """Raw rows written once, as two deliveries: a folder for the rows that are not ``late`` and one for those that are."""
    folder = workspace.fresh(raw.sparkSession, name)
    raw.withColumn("_delivery", F.when(late, 1).otherwise(0)).write.partitionBy("_delivery").parquet(folder)
    return [f"{folder}/_delivery={n}" for n in (0, 1)]


def streamed_sales(spark, sf):
    """Raw sales landed in two deliveries and streamed into bronze; silver by region and daily gold, each period as it changes.

    The orders span years, so their layers go by quarter.
    """
    root = workspace.fresh(spark, "sales_flow")
    raw = raw_sales(spark, sf).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp"))
    landed = landing(raw, F.col("event_time") >= "2000-01-01", "raw_sales")
    flow = PeriodFlow(spark, root, "quarter")
    silver, gold = PeriodTable(spark, f"{root}/silver", ["region"]), PeriodTable(spark, f"{root}/gold")
    products, customers = dimensions(spark, sf)

    def clean(rows):
        return jobs.silver_sales(rows, products, customers).withColumn(PERIOD, period_of(F.col("event_time"), "quarter"))

    def summarise(rows):
        return jobs.daily_revenue(rows, ["order_date", "category", "region", PERIOD], "total_amount", "customer_id")

    for n, folder in enumerate(landed):
        flow.bronze(io.file_stream(spark, folder, raw.schema), "event_time", f"{root}/checkpoint-{n}")
        flow.refresh(clean, silver, gold, summarise)
    return silver.read().drop(PERIOD), gold.read().drop(PERIOD)


@query("sales_silver", "PIP-25", f"""WITH {SALES_SQL}
SELECT order_id, customer_id, product_id, qty, CAST(total_amount AS DOUBLE) AS total_amount, order_date, product_name, category,
       customer_name, region, tier FROM sales""")
def sales_silver(spark, sf):
    return sales(spark, sf).select(
        "order_id", "customer_id", "product_id", big("qty").alias("qty"), real("total_amount").alias("total_amount"), "order_date",
        "product_name", "category", "customer_name", "region", "tier",
    )


@query("sales_daily_revenue", "PIP-25 AGG-24", f"""WITH {SALES_SQL}
SELECT order_date, category, region, count(order_id) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS revenue,
       CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY 1, 2, 3""")
def sales_daily_revenue(spark, sf):
    # No more sales than lines; the count reads no column.
    lines = table(spark, sf, "lineitem").count()
    out = jobs.daily_revenue(sales(spark, sf), ["order_date", "category", "region"], "total_amount", "customer_id", lines)
    return out.withColumn("revenue", real("revenue"))


@query("sales_streamed", "PIP-25 STR-13 SNK-06", REGISTRY["sales_daily_revenue"].sql)
def sales_streamed(spark, sf):
    """Daily revenue as the streamed layers hold it after two deliveries."""
    return streamed_sales(spark, sf)[1].withColumn("revenue", real("revenue"))


@query("orders_layers", "PIP-24 SNK-06 SNK-07", REGISTRY["daily_revenue"].sql)
def orders_layers(spark, sf):
    """Bronze and silver orders written by period and region; gold recomputed for the periods of each of two deliveries."""
    root = workspace.fresh(spark, "orders_flow")
    raw = raw_orders(spark, sf)
    # The copies come with the second delivery.
    landed = landing(raw, F.to_date("_ingested_at") > "2024-01-01", "raw_orders")
    flow = PeriodFlow(spark, root, "quarter")
    silver_table, gold = PeriodTable(spark, f"{root}/silver", ["region"]), PeriodTable(spark, f"{root}/gold")

    def clean(rows):
        return jobs.silver_orders(jobs.bronze_orders(rows)).withColumn(PERIOD, period_of(F.col("order_date"), "quarter"))

    def summarise(rows):
        return jobs.daily_revenue(rows, ["order_date", "region", "category", PERIOD], "amount")

    for n, folder in enumerate(landed):
        flow.bronze(io.file_stream(spark, folder, raw.schema), "order_date", f"{root}/checkpoint-{n}")
        flow.refresh(clean, silver_table, gold, summarise)
    return gold.read().drop(PERIOD).withColumn("revenue", real("revenue"))


@query("sales_customer_rank", "PIP-25 WIN-02", f"""WITH {SALES_SQL},
v AS (SELECT customer_id, customer_name, region, tier, count(order_id) AS total_orders, sum(total_amount) AS ltv,
             count(DISTINCT category) AS categories_bought FROM sales GROUP BY 1, 2, 3, 4)
SELECT customer_id, customer_name, region, tier, total_orders, CAST(ltv AS DOUBLE) AS lifetime_value, categories_bought,
       dense_rank() OVER (PARTITION BY region ORDER BY ltv DESC) AS region_rank FROM v""")
def sales_customer_rank(spark, sf):
    values = jobs.customer_value(sales(spark, sf), ["customer_id", "customer_name", "region", "tier"], "total_amount")
    # The rank measures its groups first; store the values so they are computed once.
    ranked = jobs.value_rank(workspace.stage(values, "customer_values"), "region", "customer_id")
    return ranked.withColumn("lifetime_value", real("lifetime_value"))


@query("product_trend", "PIP-25 WIN-17", f"""WITH {SALES_SQL},
d AS (SELECT order_date, category, count(order_id) AS units_sold, sum(total_amount) AS revenue FROM sales GROUP BY 1, 2)
SELECT order_date, category, units_sold, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue - coalesce(lag(revenue) OVER (PARTITION BY category ORDER BY order_date), 0) AS DOUBLE) AS revenue_delta FROM d""")
def product_trend(spark, sf):
    out = jobs.product_trend(sales(spark, sf), ["category"], "category", "total_amount")
    return out.withColumns({"revenue": real("revenue"), "revenue_delta": real("revenue_delta")})


@query("sales_questions", "PIP-25 AGG-23", f"""WITH {SALES_SQL},
v AS (SELECT customer_id, tier, sum(total_amount) AS ltv FROM sales GROUP BY 1, 2)
SELECT 'category' AS question, category AS answer, CAST(sum(total_amount) AS DOUBLE) AS amount FROM sales GROUP BY 2
UNION ALL SELECT 'tier', tier, CAST(sum(ltv) AS DOUBLE) / count(*) FROM v GROUP BY 2
UNION ALL SELECT 'region', region, CAST(sum(total_amount) AS DOUBLE) FROM sales GROUP BY 2""")
def sales_questions(spark, sf):
    """Three questions answered from the layers that the sales stream feeds."""
    rows, daily = streamed_sales(spark, sf)
    values = jobs.customer_value(rows, ["customer_id", "tier"], "total_amount")

    def answer(name, df, key, amount):
        return df.groupBy(F.col(key).alias("answer")).agg(amount.alias("amount")).withColumn("question", F.lit(name))

    return (
        answer("category", daily, "category", real(F.sum("revenue")))
        .unionByName(answer("tier", values, "tier", real(F.sum("lifetime_value")) / F.count(F.lit(1))))
        .unionByName(answer("region", daily, "region", real(F.sum("revenue"))))
    )


@query("staged_run", "PIP-27 QLT-02 QLT-06", f"""WITH {RAW_SQL}
SELECT 1::BIGINT AS position, 'bronze' AS step, 'done' AS status, (SELECT count(*) FROM raw) AS n_rows
UNION ALL SELECT 2, 'silver', 'done', (SELECT count(*) FROM silver)
UNION ALL SELECT 3, 'gold', 'done', (SELECT count(*) FROM (SELECT DISTINCT order_date, region, category FROM silver))
UNION ALL SELECT 4, 'empty', 'failed', NULL UNION ALL SELECT 5, 'export', 'skipped', NULL""")
def staged_run(spark, sf):
    """Layers written in order, row counts observed while writing, stop at the first failure."""
    folder = workspace.fresh(spark, "run")

    def write(df, layer):
        watched, seen = quality.counted(df, layer, {})
        watched.write.parquet(f"{folder}/{layer}")
        return seen.get["rows"]

    def read(layer):
        return spark.read.parquet(f"{folder}/{layer}")

    steps = [
        Step("bronze", lambda: write(jobs.bronze_orders(raw_orders(spark, sf)), "bronze")),
        Step("silver", lambda: write(jobs.silver_orders(read("bronze")), "silver"), ["bronze"]),
        Step("gold", lambda: write(jobs.daily_revenue(read("silver"), ["order_date", "region", "category"], "amount"), "gold"),
             ["silver"]),
        Step("empty", lambda: write(quality.require_rows(read("gold").filter("revenue < 0"), "losses"), "losses"), ["gold"]),
        Step("export", lambda: write(read("gold"), "export"), ["gold"]),
    ]
    return run_steps(spark, steps).select(big("position").alias("position"), "step", "status", "n_rows")
