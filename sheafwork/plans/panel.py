"""Silver panels and gold metrics for annual country panels (PIP-02..23)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.operators.columns import add_lookups, growth_pct, literal_map, share_pct
from sheafwork.operators.dedup import keep_one
from sheafwork.operators.reshape import wide_sums
from sheafwork.operators.windows import previous_period


# --- silver -----------------------------------------------------------------


def conform_named(bronze: DataFrame, codes: Mapping[str, str], mode: str = "Cars") -> DataFrame:
    """PIP-02: named-region rows to coded silver rows.

    The newest load wins when a natural key repeats. The mode filter comes
    first: mode is part of the key, so the order does not change the result and
    the shuffle carries less.
    """
    return (
        keep_one(
            bronze.filter(F.col("mode") == mode),
            ["region", "parameter", "mode", "powertrain", "year"],
            [F.col("ingested_at"), F.col("source_file")],
        )
        .select(
            literal_map(codes)[F.col("region")].alias("country_code"),
            F.col("region").alias("country_name"),
            "year",
            "parameter",
            "powertrain",
            F.col("value").alias("ev_count"),
            "unit",
        )
    )


def conform_coded(
    bronze: DataFrame,
    labels: Mapping[str, str],
    categories: Mapping[str, str],
    aggregate_geos: Sequence[str],
    value_name: str,
    aggregate_fuels: Sequence[str] = (),
    geo_aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """PIP-03: coded cube rows to silver.

    Drops aggregate geos, null values and codes that would count their parts
    twice; keeps the newest load per key; adds label and category.
    """
    rows = bronze.filter(~F.col("geo").isin(*aggregate_geos)).filter(F.col("value").isNotNull())
    if aggregate_fuels:
        rows = rows.filter(~F.col("mot_nrg").isin(*aggregate_fuels))
    if geo_aliases:
        rows = rows.withColumn("geo", F.coalesce(literal_map(geo_aliases)[F.col("geo")], F.col("geo")))
    newest = keep_one(rows, ["geo", "mot_nrg", "time"], [F.col("ingested_at"), F.col("source_file")])
    labelled = add_lookups(newest, "mot_nrg", fuel_type_label=labels, fuel_category=categories)
    return labelled.select(
        F.col("geo").alias("country_code"),
        F.col("time").try_cast("int").alias("year"),
        F.col("mot_nrg").alias("fuel_type_code"),
        "fuel_type_label",
        "fuel_category",
        F.col("value").alias(value_name),
    )


# --- gold -------------------------------------------------------------------

KEYS = ("country_code", "year")


def category_totals(silver: DataFrame, value: str) -> DataFrame:
    """PIP-05: value by country, year and category."""
    return silver.groupBy(*KEYS, "fuel_category").agg(F.sum(value).alias(value))


def wide_categories(silver: DataFrame, value: str, names: Mapping[str, str]) -> DataFrame:
    """PIP-05 + PIP-06: one column per category, in one shuffle."""
    return wide_sums(silver, KEYS, "fuel_category", value, names)


REGISTRATION_COLUMNS = {
    "Electric": "electric_registrations",
    "ICE": "ice_registrations",
    "Hybrid": "hybrid_registrations",
    "Other": "other_registrations",
    "Total": "total_registrations",
}

STOCK_COLUMNS = {
    "Electric": "electric_stock",
    "Combustion": "combustion_stock",
    "Hybrid": "hybrid_stock",
    "Other": "other_stock",
    "Total": "total_stock",
}


def add_growth(share: DataFrame, strict: bool = False) -> DataFrame:
    """PIP-08: growth of electric registrations and change of their share."""
    prev = previous_period(
        share, ["country_code"], "year", ["electric_registrations", "ev_market_share_pct"], strict
    )
    return prev.withColumns(
        {
            "ev_yoy_growth_pct": growth_pct(
                F.col("electric_registrations"), F.col("electric_registrations_prev")
            ),
            "ev_share_yoy_change_pp": F.round(
                F.col("ev_market_share_pct") - F.col("ev_market_share_pct_prev"), 2
            ),
        }
    ).drop("electric_registrations_prev", "ev_market_share_pct_prev")


def market_share(silver: DataFrame, value: str = "new_registrations", strict: bool = False) -> DataFrame:
    """PIP-09: market share and year-over-year gold table."""
    wide = wide_categories(silver, value, REGISTRATION_COLUMNS)
    total = F.col("total_registrations")
    share = wide.withColumns(
        {
            "ev_market_share_pct": share_pct(F.col("electric_registrations"), total),
            "ice_market_share_pct": share_pct(F.col("ice_registrations"), total),
        }
    )
    return add_growth(share, strict).select(
        *KEYS,
        "total_registrations",
        "electric_registrations",
        "ice_registrations",
        "hybrid_registrations",
        "other_registrations",
        "ev_market_share_pct",
        "ice_market_share_pct",
        "ev_yoy_growth_pct",
        "ev_share_yoy_change_pp",
    )


def stock_snapshot(silver: DataFrame, value: str = "stock_count") -> DataFrame:
    """PIP-15: fleet by category with shares."""
    wide = wide_categories(silver, value, STOCK_COLUMNS)
    total = F.col("total_stock")
    return wide.select(
        *KEYS,
        "total_stock",
        "electric_stock",
        "combustion_stock",
        "hybrid_stock",
        "other_stock",
        share_pct(F.col("electric_stock"), total).alias("electric_share_pct"),
        share_pct(F.col("combustion_stock"), total).alias("combustion_share_pct"),
    )


def benchmark(shares: DataFrame, members: Sequence[str]) -> DataFrame:
    """PIP-10: weighted electric share of the member countries per year."""
    return (
        shares.filter(F.col("country_code").isin(*members))
        .filter(F.col("total_registrations") > 0)
        .groupBy("year")
        .agg(
            share_pct(F.sum("electric_registrations"), F.sum("total_registrations")).alias("eu_avg_ev_share_pct"),
            F.count_distinct("country_code").alias("eu_country_count"),
        )
    )


def second_source(
    silver: DataFrame, country: str, parameters: Mapping[str, str], aggregate_types: Sequence[str] = ()
) -> DataFrame:
    """PIP-11: one column per parameter, summed over sub-types, for one country.

    Sub-types that are already a sum of the others are left out.
    """
    rows = silver.filter(
        (F.col("country_code") == country) & F.col("parameter").isin(*parameters)
    )
    if aggregate_types:
        rows = rows.filter(~F.col("powertrain").isin(*aggregate_types))
    return wide_sums(rows, ["year"], "parameter", "ev_count", parameters)


def focus_rank(shares: DataFrame, focus: str, members: Sequence[str]) -> DataFrame:
    """PIP-13: rank of one country among the members, per year."""
    by_year = Window.partitionBy("year").orderBy(F.col("ev_market_share_pct").desc_nulls_last())
    return (
        shares.filter(F.col("country_code").isin(*members))
        .withColumn("ev_share_rank", F.rank().over(by_year))
        .filter(F.col("country_code") == focus)
        .select("year", "ev_share_rank", F.lit(len(members)).alias("eu_country_total"))
    )


def focus_summary(
    shares: DataFrame, second: DataFrame, focus: str, members: Sequence[str]
) -> DataFrame:
    """PIP-14: one country against its peers, with a second source beside it."""
    own = shares.filter(F.col("country_code") == focus)
    return (
        own.join(benchmark(shares, members), "year", "left")
        .join(second, "year", "left")
        .join(focus_rank(shares, focus, members), "year", "left")
        .select(
            "year",
            "electric_registrations",
            "total_registrations",
            "ev_market_share_pct",
            "eu_avg_ev_share_pct",
            # PIP-12: gap to the benchmark in percentage points.
            F.round(F.col("ev_market_share_pct") - F.col("eu_avg_ev_share_pct"), 2).alias("vs_eu_avg_pp"),
            "ev_yoy_growth_pct",
            "ev_share_yoy_change_pp",
            *[c for c in second.columns if c != "year"],
            "ev_share_rank",
            "eu_country_total",
            "eu_country_count",
        )
    )


# --- dashboard metrics --------------------------------------------------------


def fuel_mix(shares: DataFrame) -> DataFrame:
    """PIP-18: residual 'other' clipped at 0 and the three parts as percentages."""
    electric = F.coalesce(F.col("electric_registrations"), F.lit(0))
    ice = F.coalesce(F.col("ice_registrations"), F.lit(0))
    rest = F.greatest(F.col("total_registrations") - electric - ice, F.lit(0))
    parts = shares.select(*KEYS, electric.alias("electric"), ice.alias("ice"), rest.alias("other"))
    total = F.col("electric") + F.col("ice") + F.col("other")
    return parts.select(
        *KEYS,
        "other",
        share_pct(F.col("electric"), total).alias("electric_pct"),
        share_pct(F.col("other"), total).alias("other_pct"),
        share_pct(F.col("ice"), total).alias("ice_pct"),
    )


def pair_ratio(rows: DataFrame, part: str, other: str, name: str) -> DataFrame:
    """PIP-20: part / (part + other) in percent; rows with a zero sum are dropped."""
    both: Column = F.col(part) + F.col(other)
    return rows.filter(both > 0).withColumn(name, share_pct(F.col(part), both))


def composition(stock: DataFrame, first: int, last: int) -> DataFrame:
    """PIP-21: fleet parts for a year range, hybrid and other combined."""
    zero = F.lit(0)
    return (
        stock.filter(F.col("total_stock").isNotNull() & F.col("year").between(first, last))
        .withColumn(
            "other_combined",
            F.coalesce(F.col("hybrid_stock"), zero) + F.coalesce(F.col("other_stock"), zero),
        )
        .select(*KEYS, "combustion_stock", "other_combined", "electric_stock")
    )


def latest_point(rows: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """PIP-22: newest non-null value of every series."""
    newest = F.max_by(F.struct(period, value), F.col(period)).alias("p")
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(newest).select(*keys, "p.*")


def panel_profile(silver: DataFrame) -> DataFrame:
    """PIP-23: rows, countries and year range per category."""
    return silver.groupBy("fuel_category").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("country_code").alias("n_countries"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )
