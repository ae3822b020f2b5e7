"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import dedup, quality, skew
from sheafwork.queries.registry import big, money, query, real, table
from sheafwork.queries.relational import HOLED_SQL, holed


@query("quality_log", "QLT-01", f"""WITH {HOLED_SQL}, n AS (SELECT count(*) AS t, count(*) FILTER (priority IS NULL) AS p, count(*) FILTER (status IS NULL) AS s FROM holed)
SELECT 'orders' AS table_name, 'landing/orders' AS source_file, t AS total_rows, '{{"priority":' || p || ',"status":' || s || '}}' AS null_summary,
       true AS has_time FROM n""")
def quality_log(spark, sf):
    log = quality.quality_log(holed(spark, sf), "orders", "landing/orders")
    return log.withColumn("has_time", F.col("logged_at").isNotNull()).drop("logged_at")


@query("null_profile", "QLT-01", f"""WITH {HOLED_SQL}, n AS (SELECT count(*) AS t, count(*) FILTER (priority IS NULL) AS p, count(*) FILTER (status IS NULL) AS s FROM holed)
SELECT t AS total_rows, 'o_orderkey' AS "column", 0::BIGINT AS n_null FROM n UNION ALL SELECT t, 'priority', p FROM n
UNION ALL SELECT t, 'status', s FROM n UNION ALL SELECT t, 'amount', 0 FROM n""")
def null_profile(spark, sf):
    return quality.null_counts(holed(spark, sf))


RULES_SQL = f"""{HOLED_SQL},
typed AS (SELECT o_orderkey, priority, status, TRY_CAST(amount AS DECIMAL(18,2)) AS amount FROM holed),
checked AS (SELECT *, concat_ws(',', CASE WHEN priority IS NULL THEN 'has_priority' END, CASE WHEN status IS NULL THEN 'has_status' END,
            CASE WHEN amount IS NULL OR amount <= 2000 THEN 'large_amount' END) AS reasons FROM typed)"""


def _typed(spark, sf):
    return holed(spark, sf).withColumn("amount", F.col("amount").try_cast("decimal(18,2)"))


def _rules():
    return {
        "has_priority": F.col("priority").isNotNull(), "has_status": F.col("status").isNotNull(),
        "large_amount": F.col("amount") > 2000,
    }


@query("row_rules", "QLT-04", f"""WITH {RULES_SQL}
SELECT o_orderkey, priority, status, CAST(amount AS DOUBLE) AS amount FROM checked WHERE reasons = ''""")
def row_rules(spark, sf):
    valid, _ = quality.split_rows(_typed(spark, sf), _rules())
    return valid.withColumn("amount", real("amount"))


@query("quarantine", "QLT-04", f"""WITH {RULES_SQL} SELECT o_orderkey, reasons FROM checked WHERE reasons <> ''""")
def quarantine(spark, sf):
    _, rejected = quality.split_rows(_typed(spark, sf), _rules())
    return rejected.select("o_orderkey", F.concat_ws(",", "reasons").alias("reasons"))


@query("duplicate_keys", "QLT-05", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", big("l_linenumber").alias("l_linenumber"))
    return dedup.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query("record_status", "QLT-06", f"""WITH {HOLED_SQL},
t AS (SELECT TRY_CAST(amount AS DECIMAL(18,2)) - 200000 AS amount FROM holed)
SELECT CASE WHEN amount IS NULL THEN 'NULL' WHEN amount <= 0 THEN 'INVALID' ELSE 'OK' END AS status, count(*) AS n FROM t GROUP BY 1""")
def record_status(spark, sf):
    amount = F.col("amount").try_cast("decimal(18,2)") - 200000
    rows = holed(spark, sf).select(quality.status_of(amount).alias("status"))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_categories", "QLT-06 AGG-10", """
SELECT string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses,
       string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders""")
def distinct_categories(spark, sf):
    """Unique values seen, gathered in an ordinary aggregate over small domains."""
    return table(spark, sf, "orders").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"),
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"),
    )


@query("key_skew", "QLT-07", """
SELECT user_id, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) AS share FROM events GROUP BY 1""")
def key_skew(spark, sf):
    return quality.key_skew(table(spark, sf, "events"), ["user_id"])


@query("hot_key_report", "QLT-07 JON-16", """
SELECT p_type AS category, l_returnflag AS flag, CAST(ceil(count(*) / 2000.0) AS INTEGER) AS parts
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING count(*) > 2000""")
def hot_key_report(spark, sf):
    """Keys of two columns with more than 2000 rows: candidates from a sketch, counted exactly."""
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    lines = table(spark, sf, "lineitem").select("l_partkey", F.col("l_returnflag").alias("flag"))
    rows = workspace.stage(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("category", "flag"), "line_keys")
    return skew.hot_keys(rows, ["category", "flag"], 2000).withColumnRenamed("_parts", "parts")


@query("masked_view", "QLT-09", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE '***' END AS c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS balance FROM customer WHERE c_nationkey <= 12""")
def masked_view(spark, sf):
    rows = table(spark, sf, "customer").withColumn("balance", real(money("c_acctbal")))
    out = quality.masked(
        rows, {"c_name": F.lit("***"), "balance": F.lit(None)}, F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") <= 12
    )
    return out.select("c_custkey", "c_name", "balance")
