"""Queries over landed files that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.plans import bronze, panel
from sheafwork.plans.refdata import AGGREGATE_GEOS
from sheafwork.queries.panel import LONG, TYPE_CATEGORIES, _cases, long_panel
from sheafwork.queries.registry import big, money, query, real, table
from sheafwork.sinks import layers
from sheafwork.sources import cube, files, landing

DIMS = ("freq", "mot_nrg", "geo", "time")


def cube_rows(spark, sf):
    """The long panel in cube shape: fuel code, country, year."""
    return long_panel(spark, sf).select(
        F.lit("A").alias("freq"), F.col("fuel_type_code").alias("mot_nrg"), F.col("country_code").alias("geo"),
        F.col("year").cast("string").alias("time"), real("value").alias("value"),
    )


def land_cubes(spark, rows, folder=None, suffix=""):
    """Write one cube document per country into ``folder``.

    A document has at most codes x years cells.
    """
    folder = folder or workspace.fresh(spark, "cubes")
    docs = cube.encode(rows, DIMS, "value", F.concat("geo", F.lit(suffix)))
    docs.withColumnRenamed("document", "value").write.mode("append").partitionBy("_part").text(folder)
    return folder


@query("cube_decode", "SRC-10", f"""WITH {LONG}
SELECT 'A' AS freq, code AS mot_nrg, geo, CAST(year AS VARCHAR) AS time, CAST(value AS DOUBLE) AS value FROM long""")
def cube_decode(spark, sf):
    """Cells written as cube documents and decoded again."""
    rows = workspace.stage(cube_rows(spark, sf), "cube_rows")
    return cube.decode(cube.split_documents(cube.read_cubes(spark, land_cubes(spark, rows), "*.txt"))[0], DIMS).drop("source_file")


@query("bronze_incremental", "PIP-01 SRC-11 SNK-01", f"""WITH {LONG}
SELECT code AS mot_nrg, geo, CAST(year AS VARCHAR) AS time, CAST(value AS DOUBLE) AS value, 'cube_feed' AS source_name,
       true AS has_file FROM long""")
def bronze_incremental(spark, sf):
    """Two loads of a growing landing folder; the second adds only what is new."""
    rows = workspace.stage(cube_rows(spark, sf), "cube_rows")
    folder, target = land_cubes(spark, rows.filter(F.col("time") <= "1998")), workspace.fresh(spark, "bronze")
    bronze.ingest_cubes(spark, folder, DIMS, "cube_feed", target, f"{target}_checkpoint", "*.txt")
    land_cubes(spark, rows.filter(F.col("time") > "1998"), folder, "_again")
    bronze.ingest_cubes(spark, folder, DIMS, "cube_feed", target, f"{target}_checkpoint", "*.txt")
    return spark.read.parquet(target).select(
        "mot_nrg", "geo", "time", "value", "source_name", F.col("source_file").isNotNull().alias("has_file")
    )


@query("content_skip", "SRC-12", f"""WITH {LONG} SELECT geo, count(*) AS cells FROM long GROUP BY 1""")
def content_skip(spark, sf):
    """The same cubes landed again under new names between two loads: the second load skips them."""
    rows = workspace.stage(cube_rows(spark, sf), "cube_rows")
    folder, target = land_cubes(spark, rows), workspace.fresh(spark, "bronze")
    bronze.ingest_cubes(spark, folder, DIMS, "cube_feed", target, f"{target}_checkpoint", "*.txt")
    land_cubes(spark, rows, folder, "_again")
    bronze.ingest_cubes(spark, folder, DIMS, "cube_feed", target, f"{target}_checkpoint", "*.txt")
    return spark.read.parquet(target).groupBy("geo").agg(F.count(F.lit(1)).alias("cells"))


CSV_SCHEMA = "region string, category string, parameter string, mode string, powertrain string, year int, unit string, value double"


@query("csv_bronze_silver", "SRC-01 PIP-01 PIP-02 SNK-04 PRJ-22", """
SELECT replace(n_name, 'NATION_', 'N') AS country_code, n_name AS country_name, CAST(year(l_shipdate) AS BIGINT) AS year, 'EV sales' AS parameter,
       l_returnflag AS powertrain, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS ev_count, 'Vehicles' AS unit
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_linestatus = 'O' GROUP BY 2, 3, 5""")
def csv_bronze_silver(spark, sf):
    """CSV landing with a revised second delivery, loaded to bronze and conformed."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_linestatus", "l_returnflag", "l_shipdate", "l_quantity")
    nations = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = (
        lines.join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("n_name").alias("region"), F.year("l_shipdate").alias("year"),
                 F.when(F.col("l_linestatus") == "O", "Cars").otherwise("Vans").alias("mode"),
                 F.col("l_returnflag").alias("powertrain"))
        .agg(real(F.sum(money("l_quantity"))).alias("value"))
        .select("region", F.lit("Historical").alias("category"), F.lit("EV sales").alias("parameter"), "mode", "powertrain",
                "year", F.lit("Vehicles").alias("unit"), "value")
    )
    rows = workspace.stage(rows, "csv_rows")
    folder = workspace.fresh(spark, "csv")
    # The first delivery carries wrong figures, the second the right ones.
    layers.write_files(rows.withColumn("value", F.col("value") + 1), folder, "csv")
    target = workspace.fresh(spark, "csv_bronze")
    bronze.ingest_csv(spark, folder, CSV_SCHEMA, "csv_feed", target, f"{target}_checkpoint")
    layers.write_files(rows, folder, "csv", "append")
    bronze.ingest_csv(spark, folder, CSV_SCHEMA, "csv_feed", target, f"{target}_checkpoint")
    names = [r[0] for r in table(spark, sf, "nation").select("n_name").distinct().collect()]  # one row per nation
    silver = panel.conform_named(spark.read.parquet(target), {n: n.replace("NATION_", "N") for n in names})
    return silver.withColumn("year", big("year"))


@query("conform_coded", "PIP-03 PRJ-09 PRJ-17", f"""WITH {LONG}
SELECT geo AS country_code, year, code AS fuel_type_code, lower(code) AS fuel_type_label, {_cases(TYPE_CATEGORIES)} AS fuel_category,
       CAST(value AS DOUBLE) AS new_registrations FROM long WHERE code <> 'PROMO'""")
def conform_coded(spark, sf):
    """Bronze with aggregate geos, nulls and stale revisions, conformed to silver."""
    rows = workspace.stage(cube_rows(spark, sf), "coded_rows")
    first, second = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    current = rows.withColumns({"source_file": F.lit("b"), "ingested_at": second})
    stale = rows.withColumns({"value": F.col("value") - 1, "source_file": F.lit("a"), "ingested_at": first})
    empty = current.withColumns({"value": F.lit(None).cast("double"), "ingested_at": F.lit("2024-03-01").cast("timestamp")})
    europe = current.withColumn("geo", F.lit(AGGREGATE_GEOS[0]))
    everything = current.unionByName(stale).unionByName(empty).unionByName(europe)
    labels = {c: c.lower() for c in TYPE_CATEGORIES}
    silver = panel.conform_coded(
        everything, labels, TYPE_CATEGORIES, AGGREGATE_GEOS, "new_registrations", aggregate_fuels=["PROMO"]
    )
    return silver.withColumn("year", big("year"))


@query("landing_files", "SRC-13 SRC-14", "SELECT 'part' AS kind, true AS has_size, count(DISTINCT r_regionkey) AS groups FROM region")
def landing_files(spark, sf):
    """Newest file of every folder of a landing zone (one folder per region)."""
    nations = table(spark, sf, "nation").select("n_name", "n_regionkey")
    folder = workspace.fresh(spark, "landing")
    layers.write_partitioned(nations, folder, ["n_regionkey"])
    listed = landing.list_files(spark, folder, "*.parquet")
    newest = landing.newest_per_group(listed, landing.folder_of(F.col("path")))
    return newest.agg(
        F.lit("part").alias("kind"), F.min(F.col("bytes") > 0).alias("has_size"), F.count(F.lit(1)).alias("groups")
    )


@query("json_lines_scan", "SRC-03 SNK-04", "SELECT event_id, user_id, event_type, value FROM events")
def json_lines_scan(spark, sf):
    folder = workspace.fresh(spark, "events_json")
    layers.write_files(table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), folder, "json")
    return files.read_json_lines(spark, folder, "event_id bigint, user_id bigint, event_type string, value double")


@query("csv_quarantine", "SRC-02 QLT-04", """
SELECT o_orderkey % 10 = 0 AS is_bad, count(*) AS n FROM orders GROUP BY 1""")
def csv_quarantine(spark, sf):
    """Rows whose number does not parse keep their raw text in the corrupt column."""
    folder = workspace.fresh(spark, "orders_csv")
    dirty = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "INVALID").otherwise(F.col("o_totalprice").cast("string")).alias("amount")
    )
    layers.write_files(dirty, folder, "csv")
    # Stored once parsed: a query that needs only the corrupt column would prune
    # the columns whose parsing decides what is corrupt.
    rows = workspace.stage(files.read_csv_checked(spark, folder, "o_orderkey bigint, amount double"), "orders_checked")
    return rows.groupBy(F.col(files.CORRUPT).isNotNull().alias("is_bad")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("sql_file_table", "SRC-08 SRC-09 SRC-16", "SELECT p_brand, count(*) AS n FROM part WHERE p_size > 20 GROUP BY 1")
def sql_file_table(spark, sf):
    """A SQL table declared over existing files, queried by name, then dropped."""
    name = "parts_" + workspace.fresh(spark, "t").rsplit("-", 1)[1]
    files.file_table(spark, name, "parquet", f"{sf}/part.parquet")
    found = spark.sql(
        "SELECT p_brand, count(*) AS n FROM IDENTIFIER(:t) WHERE p_size > :least GROUP BY p_brand",
        args={"t": name, "least": 20},
    )
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name})
    return found


@query("partition_overwrite", "SNK-06 SNK-07", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS rewritten FROM orders GROUP BY 1""")
def partition_overwrite(spark, sf):
    """A second write replaces one partition and leaves the others alone."""
    folder = workspace.fresh(spark, "orders_by_status")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(0).cast("bigint").alias("version"))
    layers.write_partitioned(orders, folder, ["o_orderstatus"])
    again = orders.filter(F.col("o_orderstatus") == "F").withColumn("version", F.lit(1).cast("bigint"))
    layers.write_partitioned(again, folder, ["o_orderstatus"])
    return spark.read.parquet(folder).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("version").alias("rewritten")
    )
