"""Country panels derived from the order tables, and the gold metrics on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import joins, ordering, windows
from sheafwork.operators.columns import add_lookups
from sheafwork.plans import panel
from sheafwork.queries.registry import big, money, query, real, table

# How the part types of the order tables stand in for fuel codes.
TYPE_CATEGORIES = {
    "ECONOMY": "Electric", "SMALL": "Electric", "MEDIUM": "Hybrid",
    "LARGE": "ICE", "STANDARD": "ICE", "PROMO": "Other", "TOTAL": "Total",
}
STOCK_CATEGORIES = {c: "Combustion" if v == "ICE" else v for c, v in TYPE_CATEGORIES.items()}
MEMBERS = ("NATION_3", "NATION_8", "NATION_13", "NATION_18", "NATION_23")
FOCUS = "NATION_3"


def long_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity by customer country, order year and part type, plus TOTAL rows."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", money("l_quantity").alias("value"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country_code"))
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("fuel_type_code"))
    # Customers meet orders first, so that the line items, the largest input, are
    # shuffled for two joins only. Names are added to the finished sums.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey", "year")
    sums = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("c_nationkey", "year", "fuel_type_code")
        .agg(F.sum("value").alias("value"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    with_total = sums.withColumn("fuel_type_code", F.explode(F.array("fuel_type_code", F.lit("TOTAL"))))
    return with_total.groupBy("country_code", "year", "fuel_type_code").agg(F.sum("value").alias("value"))


def registrations(spark: SparkSession, sf: str) -> DataFrame:
    rows = add_lookups(long_panel(spark, sf), "fuel_type_code", fuel_category=TYPE_CATEGORIES)
    return rows.withColumnRenamed("value", "new_registrations")


def stock(spark: SparkSession, sf: str) -> DataFrame:
    """Fleet by code: running total of the yearly flow (a bounded yearly series)."""
    series = (
        Window.partitionBy("country_code", "fuel_type_code").orderBy("year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = long_panel(spark, sf).withColumn("stock_count", F.sum("value").over(series)).drop("value")
    return add_lookups(rows, "fuel_type_code", fuel_category=STOCK_CATEGORIES)


def shares(spark: SparkSession, sf: str) -> DataFrame:
    return panel.market_share(registrations(spark, sf))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """The market-share table, stored once for jobs that read it several times."""
    return workspace.stage(shares(spark, sf), "market_share")


def second_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A second source: sales and running stock by supplier country and line status.

    An ALL sub-type that sums the others is part of the data, as in sources that
    publish both parts and totals.
    """
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), "l_linestatus", money("l_extendedprice").alias("v")
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    sums = (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "year", "l_linestatus").agg(F.sum("v").alias("sales"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    typed = sums.select(
        F.col("n_name").alias("country_code"), "year", "sales",
        F.explode(F.array("l_linestatus", F.lit("ALL"))).alias("powertrain"),
    ).groupBy("country_code", "year", "powertrain").agg(F.sum("sales").alias("sales"))
    series = (
        Window.partitionBy("country_code", "powertrain").orderBy("year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = typed.withColumn("stock", F.sum("sales").over(series))
    return both.unpivot(
        ["country_code", "year", "powertrain"], ["sales", "stock"], "parameter", "ev_count"
    )


# --- SQL building blocks ------------------------------------------------------


def pct(part: str, whole: str) -> str:
    """Exact half-up percentage with two decimals, from whole numbers."""
    return (
        f"(CASE WHEN {whole} > 0 THEN CAST(sign({part}) * ((20000 * abs({part}) + {whole}) // (2 * {whole}))"
        " AS DOUBLE) / 100 END)"
    )


def _cases(mapping: dict[str, str]) -> str:
    return "CASE code " + " ".join(f"WHEN '{c}' THEN '{v}'" for c, v in mapping.items()) + " END"


LONG = """
base AS (
  SELECT n_name AS geo, CAST(year(o_orderdate) AS BIGINT) AS year, p_type AS code,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3),
long AS (
  SELECT * FROM base
  UNION ALL SELECT geo, year, 'TOTAL', CAST(sum(value) AS BIGINT) FROM base GROUP BY 1, 2)
"""


def _wide(source: str, ice: str) -> str:
    def one(cat: str) -> str:
        return f"CAST(sum(CASE WHEN cat = '{cat}' THEN value END) AS BIGINT)"

    return (
        f"SELECT geo, year, {one('Electric')} AS e, {one(ice)} AS i, {one('Hybrid')} AS h,"
        f" {one('Other')} AS o, {one('Total')} AS t FROM {source} GROUP BY 1, 2"
    )


SHARES = f"""{LONG},
cat AS (SELECT *, {_cases(TYPE_CATEGORIES)} AS cat FROM long),
wide AS ({_wide('cat', 'ICE')}),
ms AS (
  SELECT geo AS country_code, year, t, e, i, h, o, {pct('e', 't')} AS ev, {pct('i', 't')} AS ice,
         lag(e) OVER w AS e_prev, lag(year) OVER w AS y_prev, lag({pct('e', 't')}) OVER w AS ev_prev
  FROM wide WINDOW w AS (PARTITION BY geo ORDER BY year)),
gold AS (
  SELECT country_code, year, t, e, i, h, o, ev, ice, y_prev,
         {pct('(e - e_prev)', 'e_prev')} AS yoy, round(ev - ev_prev, 2) AS pp FROM ms)
"""

STOCK = f"""{LONG},
run AS (SELECT geo, year, code, CAST(sum(value) OVER (PARTITION BY geo, code ORDER BY year) AS BIGINT) AS value FROM long),
cat AS (SELECT *, {_cases(STOCK_CATEGORIES)} AS cat FROM run),
wide AS ({_wide('cat', 'Combustion')}),
snap AS (SELECT geo AS country_code, year, t, e, i, h, o, {pct('e', 't')} AS es, {pct('i', 't')} AS cs FROM wide)
"""

_MEMBERS = ", ".join(f"'{m}'" for m in MEMBERS)
_GOLD_COLUMNS = """country_code, year, CAST(t AS DOUBLE) AS total_registrations,
  CAST(e AS DOUBLE) AS electric_registrations, CAST(i AS DOUBLE) AS ice_registrations,
  CAST(h AS DOUBLE) AS hybrid_registrations, CAST(o AS DOUBLE) AS other_registrations,
  ev AS ev_market_share_pct, ice AS ice_market_share_pct,
  {yoy} AS ev_yoy_growth_pct, {pp} AS ev_share_yoy_change_pp"""


def _plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and all other numbers as double."""
    kinds = dict(df.dtypes)
    return df.select(
        [
            big(c).alias(c) if kinds[c] == "int" else real(c).alias(c) if kinds[c].startswith("decimal") else F.col(c)
            for c in df.columns
        ]
    )


# --- queries ------------------------------------------------------------------


@query("market_share", "PIP-05..09 PRJ-16 PRJ-17 AGG-14 WIN-06 WIN-16",
       f"WITH {SHARES} SELECT {_GOLD_COLUMNS.format(yoy='yoy', pp='pp')} FROM gold")
def market_share(spark, sf):
    return _plain(shares(spark, sf))


# The panel without one country-year, so that the previous row is two years back.
@query("strict_yoy", "WIN-16", f"""WITH {SHARES},
holed AS (SELECT * FROM ms WHERE NOT (country_code = 'NATION_7' AND year = 1998)),
again AS (SELECT *, lag(e) OVER w AS ep, lag(year) OVER w AS yp, lag(ev) OVER w AS evp
          FROM holed WINDOW w AS (PARTITION BY country_code ORDER BY year)),
kept AS (SELECT *, CASE WHEN year - yp = 1 THEN ep END AS ep1, CASE WHEN year - yp = 1 THEN evp END AS evp1 FROM again)
SELECT {_GOLD_COLUMNS.format(yoy=pct('(e - ep1)', 'ep1'), pp='round(ev - evp1, 2)')} FROM kept""")
def strict_yoy(spark, sf):
    rows = registrations(spark, sf).filter(~((F.col("country_code") == "NATION_7") & (F.col("year") == 1998)))
    return _plain(panel.market_share(rows, strict=True))


@query("category_totals", "PIP-05 AGG-02",
       f"WITH {LONG}, cat AS (SELECT *, {_cases(TYPE_CATEGORIES)} AS cat FROM long) SELECT geo AS country_code, year,"
       " cat AS fuel_category, CAST(sum(value) AS DOUBLE) AS new_registrations FROM cat GROUP BY 1, 2, 3")
def category_totals(spark, sf):
    return _plain(panel.category_totals(registrations(spark, sf), "new_registrations"))


@query("benchmark_share", "PIP-10 AGG-22 AGG-06", f"""WITH {SHARES}
SELECT year, {pct('CAST(sum(e) AS BIGINT)', 'CAST(sum(t) AS BIGINT)')} AS eu_avg_ev_share_pct,
       count(DISTINCT country_code) AS eu_country_count
FROM gold WHERE country_code IN ({_MEMBERS}) AND t > 0 GROUP BY year""")
def benchmark_share(spark, sf):
    return _plain(panel.benchmark(shares(spark, sf), MEMBERS))


@query("focus_rank", "PIP-13 WIN-18 WIN-01", f"""WITH {SHARES},
r AS (SELECT country_code, year, rank() OVER (PARTITION BY year ORDER BY ev DESC NULLS LAST) AS rnk
      FROM gold WHERE country_code IN ({_MEMBERS}))
SELECT year, CAST(rnk AS BIGINT) AS ev_share_rank, CAST({len(MEMBERS)} AS BIGINT) AS eu_country_total
FROM r WHERE country_code = '{FOCUS}'""")
def focus_rank(spark, sf):
    return _plain(panel.focus_rank(shares(spark, sf), FOCUS, MEMBERS))


SECOND = """
s0 AS (SELECT n_name AS country_code, CAST(year(l_shipdate) AS BIGINT) AS year, l_linestatus AS powertrain,
              sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sales
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3),
s1 AS (SELECT *, sum(sales) OVER (PARTITION BY country_code, powertrain ORDER BY year) AS stock FROM s0),
s2 AS (SELECT country_code, year, sum(sales) AS sales, sum(stock) AS stock FROM s1 GROUP BY 1, 2)
"""


def second_for(spark, sf, country):
    return panel.second_source(
        second_rows(spark, sf), country, {"sales": "ev_sales_iea", "stock": "ev_stock_iea"}, ["ALL"]
    )


@query("second_source", "PIP-11 AGG-14", f"""WITH {SECOND}
SELECT year, CAST(sales AS DOUBLE) AS ev_sales_iea, CAST(stock AS DOUBLE) AS ev_stock_iea
FROM s2 WHERE country_code = '{FOCUS}'""")
def second_source(spark, sf):
    return _plain(second_for(spark, sf, FOCUS))


@query("focus_summary", "PIP-10..14 JON-17 JON-02", f"""WITH {SHARES}, {SECOND},
bench AS (SELECT year, {pct('CAST(sum(e) AS BIGINT)', 'CAST(sum(t) AS BIGINT)')} AS avg_share, count(DISTINCT country_code) AS n
          FROM gold WHERE country_code IN ({_MEMBERS}) AND t > 0 GROUP BY year),
r AS (SELECT country_code, year, rank() OVER (PARTITION BY year ORDER BY ev DESC NULLS LAST) AS rnk
      FROM gold WHERE country_code IN ({_MEMBERS}))
SELECT g.year, CAST(e AS DOUBLE) AS electric_registrations, CAST(t AS DOUBLE) AS total_registrations,
       ev AS ev_market_share_pct, avg_share AS eu_avg_ev_share_pct, round(ev - avg_share, 2) AS vs_eu_avg_pp,
       yoy AS ev_yoy_growth_pct, pp AS ev_share_yoy_change_pp,
       CAST(sales AS DOUBLE) AS ev_sales_iea, CAST(stock AS DOUBLE) AS ev_stock_iea,
       CAST(rnk AS BIGINT) AS ev_share_rank, CAST({len(MEMBERS)} AS BIGINT) AS eu_country_total, n AS eu_country_count
FROM gold g LEFT JOIN bench ON bench.year = g.year
     LEFT JOIN s2 ON s2.year = g.year AND s2.country_code = '{FOCUS}'
     LEFT JOIN r ON r.year = g.year AND r.country_code = '{FOCUS}'
WHERE g.country_code = '{FOCUS}'""")
def focus_summary(spark, sf):
    return _plain(panel.focus_summary(gold(spark, sf), second_for(spark, sf, FOCUS), FOCUS, MEMBERS))


@query("stock_snapshot", "PIP-15 WIN-08", f"""WITH {STOCK}
SELECT country_code, year, CAST(t AS DOUBLE) AS total_stock, CAST(e AS DOUBLE) AS electric_stock,
       CAST(i AS DOUBLE) AS combustion_stock, CAST(h AS DOUBLE) AS hybrid_stock, CAST(o AS DOUBLE) AS other_stock,
       es AS electric_share_pct, cs AS combustion_share_pct FROM snap""")
def stock_snapshot(spark, sf):
    return _plain(panel.stock_snapshot(stock(spark, sf)))


def _top(gold_table, k=10):
    return ordering.latest_top_k(
        gold_table, "year", F.col("total_registrations") > 1000,
        [F.col("ev_market_share_pct").desc_nulls_last(), F.col("country_code")], k,
    ).select("country_code", "year", "electric_registrations", "total_registrations", "ev_market_share_pct")


_LATEST_TOP = """top AS (SELECT * FROM gold WHERE year = (SELECT max(year) FROM gold) AND t > 1000
  ORDER BY ev DESC NULLS LAST, country_code LIMIT {k})"""


@query("latest_topk", "PIP-16 SRT-03", f"""WITH {SHARES}, {_LATEST_TOP.format(k=10)}
SELECT country_code, year, CAST(e AS DOUBLE) AS electric_registrations, CAST(t AS DOUBLE) AS total_registrations,
       ev AS ev_market_share_pct FROM top""")
def latest_topk(spark, sf):
    return _plain(_top(gold(spark, sf)))


@query("latest_stock_topk", "PIP-16 SRT-03", f"""WITH {STOCK}
SELECT country_code, year, CAST(t AS DOUBLE) AS total_stock, CAST(e AS DOUBLE) AS electric_stock, es AS electric_share_pct
FROM snap WHERE year = (SELECT max(year) FROM snap) AND t > 10000
ORDER BY es DESC NULLS LAST, country_code LIMIT 10""")
def latest_stock_topk(spark, sf):
    snapshot = workspace.stage(panel.stock_snapshot(stock(spark, sf)), "stock_snapshot")
    top = ordering.latest_top_k(
        snapshot, "year", F.col("total_stock") > 10000,
        [F.col("electric_share_pct").desc_nulls_last(), F.col("country_code")], 10,
    )
    return _plain(top.select("country_code", "year", "total_stock", "electric_stock", "electric_share_pct"))


@query("topk_with_focus", "PIP-17 PIP-22 SRT-04 JON-07", f"""WITH {SHARES}, {_LATEST_TOP.format(k=3)},
own AS (SELECT country_code, year, ev FROM gold WHERE country_code = '{FOCUS}' AND ev IS NOT NULL ORDER BY year DESC LIMIT 1)
SELECT country_code, year, ev AS ev_market_share_pct, CAST(t AS DOUBLE) AS total_registrations FROM top
UNION ALL
SELECT country_code, year, ev, NULL FROM own WHERE country_code NOT IN (SELECT country_code FROM top)""")
def topk_with_focus(spark, sf):
    stored = gold(spark, sf)
    top = _top(stored, 3).select("country_code", "year", "ev_market_share_pct", "total_registrations")
    own = panel.latest_point(
        stored.filter(F.col("country_code") == FOCUS), ["country_code"], "year", "ev_market_share_pct"
    )
    return _plain(ordering.with_forced_rows(top, own, "country_code"))


@query("index_to_base", "PIP-19 WIN-11", f"""WITH {SHARES},
b AS (SELECT *, first_value(e) OVER w AS be, first_value(i) OVER w AS bi FROM gold
      WHERE e IS NOT NULL AND i IS NOT NULL WINDOW w AS (PARTITION BY country_code ORDER BY year))
SELECT country_code, year, CASE WHEN be <> 0 THEN CAST(e AS DOUBLE) / be * 100 END AS electric_registrations_idx,
       CASE WHEN bi <> 0 THEN CAST(i AS DOUBLE) / bi * 100 END AS ice_registrations_idx FROM b""")
def index_to_base(spark, sf):
    both = ["electric_registrations", "ice_registrations"]
    rows = shares(spark, sf).select("country_code", "year", *[real(c).alias(c) for c in both]).na.drop(subset=both)
    return _plain(windows.index_to_base(rows, ["country_code"], "year", both).drop(*both))


@query("fuel_mix", "PIP-18", f"""WITH {SHARES},
p AS (SELECT country_code, year, coalesce(e, 0) AS e, coalesce(i, 0) AS i,
             greatest(t - coalesce(e, 0) - coalesce(i, 0), 0) AS r FROM gold)
SELECT country_code, year, CAST(r AS DOUBLE) AS other, {pct('e', '(e + i + r)')} AS electric_pct,
       {pct('r', '(e + i + r)')} AS other_pct, {pct('i', '(e + i + r)')} AS ice_pct FROM p""")
def fuel_mix(spark, sf):
    return _plain(panel.fuel_mix(shares(spark, sf)))


@query("pair_ratio", "PIP-20", f"""WITH {SHARES}
SELECT country_code, {pct('e', '(e + i)')} AS ratio_pct FROM gold
WHERE year = (SELECT max(year) FROM gold) AND t > 1000 AND e + i > 0""")
def pair_ratio(spark, sf):
    newest = ordering.latest_rows(gold(spark, sf), "year").filter(F.col("total_registrations") > 1000)
    ratio = panel.pair_ratio(newest, "electric_registrations", "ice_registrations", "ratio_pct")
    return _plain(ratio.select("country_code", "ratio_pct"))


@query("composition", "PIP-21 PRJ-10 PRJ-12", f"""WITH {STOCK}
SELECT country_code, year, CAST(i AS DOUBLE) AS combustion_stock,
       CAST(coalesce(h, 0) + coalesce(o, 0) AS DOUBLE) AS other_combined, CAST(e AS DOUBLE) AS electric_stock
FROM snap WHERE t IS NOT NULL AND year BETWEEN 1997 AND 2000""")
def composition(spark, sf):
    return _plain(panel.composition(panel.stock_snapshot(stock(spark, sf)), 1997, 2000))


@query("latest_point", "PIP-22", f"""WITH {SHARES}
SELECT country_code, max(year) AS year, max_by(yoy, year) AS ev_yoy_growth_pct
FROM gold WHERE yoy IS NOT NULL GROUP BY 1""")
def latest_point(spark, sf):
    return _plain(panel.latest_point(shares(spark, sf), ["country_code"], "year", "ev_yoy_growth_pct"))


@query("panel_profile", "PIP-23 AGG-03 AGG-20", f"""WITH {LONG},
cat AS (SELECT *, {_cases(TYPE_CATEGORIES)} AS cat FROM long)
SELECT cat AS fuel_category, count(*) AS n_rows, count(DISTINCT geo) AS n_countries,
       min(year) AS first_year, max(year) AS last_year FROM cat GROUP BY 1""")
def panel_profile(spark, sf):
    return _plain(panel.panel_profile(registrations(spark, sf)))


@query("densified_panel", "JON-05 SRT-05", f"""WITH {LONG},
grid AS (SELECT geo, y.year FROM (SELECT DISTINCT geo FROM long WHERE code = 'TOTAL') g, (SELECT CAST(unnest(range(a, z + 1)) AS BIGINT) AS year FROM (SELECT min(year) AS a, max(year) AS z FROM long WHERE code = 'TOTAL')) y)
SELECT grid.geo AS country_code, grid.year, CAST(long.value AS DOUBLE) AS total
FROM grid LEFT JOIN long ON long.geo = grid.geo AND long.year = grid.year AND long.code = 'TOTAL'""")
def densified_panel(spark, sf):
    totals = long_panel(spark, sf).filter(F.col("fuel_type_code") == "TOTAL")
    flat = totals.select("country_code", "year", F.col("value").alias("total"))
    first, last = flat.agg(F.min("year"), F.max("year")).first()
    return _plain(joins.densify(flat, ["country_code"], "year", first, last))
