"""Sink queries: table writes, save modes, layout and shared inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import quality
from sheafwork.queries.panel import _GOLD_COLUMNS, SHARES, _plain, shares
from sheafwork.queries.registry import money, query, real, table
from sheafwork.sinks import layers
from sheafwork.sources import files


def _name(folder):
    return "t_" + folder.rsplit("-", 1)[1]


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", real(money("o_totalprice")).alias("price"))


@query("table_writes", "SNK-01 SNK-02 SNK-08 SNK-09 SRC-04", """
SELECT o_orderstatus, count(*) AS n, CAST(NULL AS DOUBLE) AS price FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1
UNION ALL SELECT 'F', 2 * count(*), NULL FROM orders WHERE o_orderstatus = 'F'""")
def table_writes(spark, sf):
    """Create from a query, insert, overwrite and append; the table is external and dropped at the end."""
    orders = _orders(spark, sf)
    folder = workspace.fresh(spark, "table")
    name = _name(folder)
    layers.create_from_query(spark, name, orders.filter(F.col("o_orderstatus") == "P"), folder)
    layers.insert_rows(spark, name, orders.filter(F.col("o_orderstatus") == "F"))
    layers.insert_rows(spark, name, orders.filter(F.col("o_orderstatus") == "F"), overwrite=True)
    layers.append_table(orders.filter(F.col("o_orderstatus") != "F"), name, folder)
    layers.append_table(orders.filter(F.col("o_orderstatus") == "F"), name, folder)
    spark.catalog.refreshTable(name)
    held = spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    # A rewrite replaces rows and schema: the count table takes the place of the orders.
    folder2 = workspace.fresh(spark, "rewritten")
    layers.rewrite_table(held.withColumn("price", F.lit(None).cast("double")), name + "_counts", folder2)
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name})
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name + "_counts"})
    return files.read_parquet(spark, folder2)


@query("single_file_export", "SNK-03", f"WITH {SHARES} SELECT {_GOLD_COLUMNS.format(yoy='yoy', pp='pp')} FROM gold")
def single_file_export(spark, sf):
    folder = workspace.fresh(spark, "export")
    layers.export_single_file(_plain(shares(spark, sf)), folder)
    return files.read_parquet(spark, folder)


@query("save_modes", "SNK-04 SNK-05", "SELECT count(*) * 2 AS n, count(DISTINCT o_orderkey) AS orders, true AS refused FROM orders")
def save_modes(spark, sf):
    """Overwrite, append, ignore and the default that refuses an existing folder."""
    orders = _orders(spark, sf)
    folder = workspace.fresh(spark, "modes")
    for mode in ("overwrite", "append", "ignore"):
        layers.write_files(orders, folder, "parquet", mode)
    try:
        layers.write_files(orders, folder, "parquet")
        refused = False
    except Exception as e:
        refused = "PATH_ALREADY_EXISTS" in str(e)
    return files.read_parquet(spark, folder).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("orders"), F.lit(refused).alias("refused")
    )


@query("repartition_layout", "SNK-10", """
SELECT 'by_count' AS layout, true AS as_asked, count(*) AS n FROM orders UNION ALL SELECT 'coalesced', true, count(*) FROM orders
UNION ALL SELECT 'by_range', true, count(*) FROM orders UNION ALL SELECT 'by_column', true, count(*) FROM orders""")
def repartition_layout(spark, sf):
    """Rows and partitions after repartition by count, by column and by range, and after coalesce."""
    orders = _orders(spark, sf).select("o_orderkey")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = max(1, n // 2)
    shapes = {
        "by_count": (orders.repartition(n), n), "coalesced": (orders.repartition(n).coalesce(half), half),
        "by_range": (orders.repartitionByRange(n, "o_orderkey"), n), "by_column": (orders.repartition(n, "o_orderkey"), n),
    }
    out = None
    for name, (df, asked) in shapes.items():
        sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("c"))
        one = sizes.agg(
            F.lit(name).alias("layout"), (F.count(F.lit(1)) == asked).alias("as_asked"), F.sum("c").alias("n")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("shared_base", "SNK-11 SNK-12", """
SELECT 'status' AS kind, o_orderstatus AS key, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def shared_base(spark, sf):
    """Two stored outputs of one cached input, which is released afterwards."""
    base = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    folder = workspace.fresh(spark, "outputs")
    with layers.shared(base) as kept:
        view = layers.publish_view(kept, "v_" + _name(folder))
        for kind, column in (("status", "o_orderstatus"), ("priority", "o_orderpriority")):
            counts = spark.sql(
                f"SELECT :kind AS kind, {column} AS key, count(*) AS n FROM IDENTIFIER(:view) GROUP BY {column}",
                args={"kind": kind, "view": view},
            )
            layers.append_rows(counts, folder)
        layers.drop_view(spark, view)
    return files.read_parquet(spark, folder)


@query("calendar_range", "SRC-07 JON-02", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT days.day, coalesce(n, 0) AS n_orders FROM days LEFT JOIN n USING (day)""")
def calendar_range(spark, sf):
    """Orders per day over a generated calendar, days without orders included."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    first, last = orders.agg(F.min("day"), F.max("day")).first()  # two dates
    days = files.number_range(spark, (last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )
    counts = orders.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("table_summary", "QLT-03 QLT-02", """
SELECT count(*) AS n_rows, 'struct<o_orderkey:bigint,o_orderstatus:string,price:double>' AS shape,
       (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5)) AS sample FROM orders""")
def table_summary(spark, sf):
    orders = quality.require_rows(_orders(spark, sf), "orders")
    found = quality.table_summary(orders, ["o_orderkey"])
    sample = ",".join(str(r["o_orderkey"]) for r in found["sample"])
    return spark.createDataFrame([(found["rows"], found["schema"], sample)], "n_rows bigint, shape string, sample string")


@query("catalog_inspection", "SNK-13 SRC-08", """
SELECT CAST(cid + 1 AS BIGINT) AS position, name, lower(type) NOT LIKE '%varchar%' AS measured, (SELECT count(*) FROM orders) AS n_rows
FROM pragma_table_info('orders')""")
def catalog_inspection(spark, sf):
    """Columns of a catalog table made from the orders, as the catalog lists them, with its rows."""
    folder = workspace.fresh(spark, "inspected")
    stored = layers.create_from_query(spark, _name(folder), table(spark, sf, "orders"), folder)
    listed = [(k, name, kind != "string") for k, (name, kind) in enumerate(layers.catalog_columns(spark, _name(folder)), 1)]
    if _name(folder) not in layers.catalog_tables(spark, spark.catalog.currentDatabase()):
        raise ValueError("the catalog does not list the table")
    columns = spark.createDataFrame(listed, "position bigint, name string, measured boolean")
    return columns.withColumn("n_rows", stored.agg(F.count(F.lit(1))).scalar())
