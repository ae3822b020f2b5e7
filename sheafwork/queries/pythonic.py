"""UDF and pandas-on-Spark queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork.functions import udfs
from sheafwork.queries.panel import LONG, long_panel
from sheafwork.queries.registry import big, query, real, table
from sheafwork.queries.relational import TYPE_LABELS, _LABEL_SQL

_SCORE = "(c_acctbal + 1000) / 110"
_GRADE = f"CASE WHEN s IS NULL THEN NULL WHEN s >= 90 THEN 'A' WHEN s >= 75 THEN 'B' WHEN s >= 60 THEN 'C' ELSE 'F' END"
SCORED = f"""scored AS (SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_custkey % 17 <> 0 THEN {_SCORE} END AS s FROM customer)"""


def scored(spark, sf):
    score = F.when(F.col("c_custkey") % 17 != 0, (F.col("c_acctbal") + 1000) / 110)
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", score.alias("score"))


@query("udf_grade", "UDF-01 UDF-03", f"""WITH {SCORED} SELECT c_custkey, {_GRADE} AS grade,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS titled FROM scored""")
def udf_grade(spark, sf):
    return scored(spark, sf).select(
        "c_custkey", udfs.grade_udf("score").alias("grade"), udfs.title_case("c_mktsegment").alias("titled")
    )


@query("udf_sql", "UDF-02 SNK-12", f"WITH {SCORED} SELECT {_GRADE} AS grade, count(*) AS n FROM scored GROUP BY 1")
def udf_sql(spark, sf):
    name = udfs.register_grade(spark)
    return spark.sql(f"SELECT {name}(score) AS grade, count(*) AS n FROM {{rows}} GROUP BY 1", rows=scored(spark, sf))


@query("udf_to_expression", "UDF-07", f"WITH {SCORED} SELECT c_custkey, {_GRADE} AS grade FROM scored")
def udf_to_expression(spark, sf):
    return scored(spark, sf).select("c_custkey", udfs.grade_expr(F.col("score")).alias("grade"))


@query("pandas_scalar", "UDF-04", "SELECT c_custkey, upper(c_name) AS upped FROM customer")
def pandas_scalar(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", udfs.upper_text("c_name").alias("upped"))


@query("pandas_iterator", "UDF-05", f"SELECT p_partkey, {_LABEL_SQL} AS label FROM part")
def pandas_iterator(spark, sf):
    return table(spark, sf, "part").select("p_partkey", udfs.coded(TYPE_LABELS)("p_type").alias("label"))


@query("zscore_group", "UDF-04 UDF-06", """
WITH s AS (SELECT c_mktsegment, avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS d FROM customer GROUP BY 1)
SELECT c_custkey, CAST(round((c_acctbal - m) / d * 100000) AS BIGINT) AS z_scaled FROM customer JOIN s USING (c_mktsegment)""")
def zscore_group(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    out = udfs.group_zscore(rows, ["c_mktsegment"], "c_acctbal", "z")
    return out.select("c_custkey", big(F.round(F.col("z") * 100000)).alias("z_scaled"))


@query("minmax_group", "UDF-04", """
SELECT c_custkey, (c_acctbal - min(c_acctbal) OVER w) / (max(c_acctbal) OVER w - min(c_acctbal) OVER w) AS scaled
FROM customer WINDOW w AS (PARTITION BY c_mktsegment)""")
def minmax_group(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return udfs.minmax_scaled(rows, ["c_mktsegment"], "c_acctbal", "scaled").select("c_custkey", "scaled")


@query("group_rank_pandas", "UDF-06", f"""WITH {LONG}
SELECT geo AS country_code, year, CAST(value AS DOUBLE) AS total, row_number() OVER (PARTITION BY geo ORDER BY value DESC, year) AS rank
FROM long WHERE code = 'TOTAL'""")
def group_rank_pandas(spark, sf):
    """Years of a country ranked by volume: a grouped map over short series."""
    series = long_panel(spark, sf).filter(F.col("fuel_type_code") == "TOTAL").select(
        "country_code", big("year").alias("year"), real("value").alias("total")
    )
    return udfs.rank_series(series, "country_code", "total", "year", "country_code string, year bigint, total double, rank bigint")


# --- pandas on Spark -------------------------------------------------------------


def _pandas_defaults():
    # Imported on use: the import changes the process environment.
    import pyspark.pandas as ps

    # A distributed index needs no ordering pass over the data.
    ps.set_option("compute.default_index_type", "distributed")


@query("pandas_group_agg", "AGG-25 SRC-15", """
SELECT c_mktsegment, min(c_acctbal) AS lowest, max(c_acctbal) AS highest, count(c_acctbal) AS n FROM customer GROUP BY 1""")
def pandas_group_agg(spark, sf):
    _pandas_defaults()
    frame = table(spark, sf, "customer").select("c_mktsegment", "c_acctbal").pandas_api()
    out = frame.groupby("c_mktsegment").agg({"c_acctbal": ["min", "max", "count"]}).reset_index()
    out.columns = ["c_mktsegment", "lowest", "highest", "n"]
    return out.to_spark()


@query("pandas_merge", "JON-18 SRC-15", """
SELECT n_name AS nation, r_name AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey + 1""")
def pandas_merge(spark, sf):
    _pandas_defaults()
    nations = table(spark, sf, "nation").select("n_name", F.col("n_regionkey").alias("key")).pandas_api()
    regions = table(spark, sf, "region").select((F.col("r_regionkey") + 1).alias("key"), "r_name").pandas_api()
    merged = nations.merge(regions, on="key", how="left")[["n_name", "r_name"]]
    return merged.rename(columns={"n_name": "nation", "r_name": "region"}).to_spark()


@query("pandas_frame", "UDF-08 UDF-09 AGG-20", """
SELECT p_brand, CAST(p_size AS BIGINT) * 2 AS doubled, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS kind FROM part WHERE p_size > 10""")
def pandas_frame(spark, sf):
    """Select, filter, derive and apply in the pandas API."""
    _pandas_defaults()
    frame = table(spark, sf, "part").select("p_brand", big("p_size").alias("p_size")).pandas_api()
    kept = frame[frame["p_size"] > 10]

    def kind(size) -> str:
        return "big" if size > 25 else "small"

    out = kept.assign(doubled=kept["p_size"] * 2, kind=kept["p_size"].apply(kind))
    return out[["p_brand", "doubled", "kind"]].to_spark()


@query("pandas_value_counts", "AGG-20 UDF-09", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def pandas_value_counts(spark, sf):
    _pandas_defaults()
    counts = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status")).pandas_api()["status"].value_counts()
    out = counts.rename("n").rename_axis("status").reset_index()
    return out.to_spark()


@query("pandas_describe", "UDF-09 AGG-19 SRC-15", """
SELECT * FROM (SELECT 'count' AS stat, CAST(count(p_size) AS DOUBLE) AS size FROM part UNION ALL SELECT 'min', min(p_size) FROM part
UNION ALL SELECT 'max', max(p_size) FROM part UNION ALL SELECT 'mean', CAST(sum(p_size) AS DOUBLE) / count(*) FROM part)""")
def pandas_describe(spark, sf):
    _pandas_defaults()
    frame = table(spark, sf, "part").select(big("p_size").alias("size")).pandas_api()
    out = frame.describe().loc[["count", "min", "max", "mean"]].rename_axis("stat").reset_index()
    return out.to_spark().select("stat", real("size").alias("size"))
