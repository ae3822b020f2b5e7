"""Small known answers for joins, windows, nulls, collections and metrics."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import nested, udfs
from sheafwork.operators import columns, dedup, joins, ordering, windows
from sheafwork.plans import orders as order_jobs
from sheafwork.plans import panel, refdata
from tests.conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    staff = spark.createDataFrame(
        [(1, "A", 10), (2, "B", 20), (3, "C", 10), (4, "D", 30), (5, "E", 99)], "id int, name string, dept int"
    )
    depts = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z"), (40, "w")], "dept int, label string")
    return staff, depts


@pytest.mark.parametrize(
    "how, n", [("inner", 4), ("left", 5), ("right", 5), ("full", 6), ("left_semi", 4), ("left_anti", 1)]
)
def test_join_kinds(people, how, n):  # JON-01..07
    staff, depts = people
    assert staff.join(depts, "dept", how).count() == n


def test_lookup_join_falls_back_when_large(people):  # JON-10
    staff, depts = people
    small = joins.lookup_join(staff, depts, "dept")
    large = joins.lookup_join(staff, depts, "dept", max_rows=2)
    assert rows(small) == rows(large)


def test_null_keys(spark):  # JON-12, JON-13
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("k", 4)], "k string, b int")
    assert a.join(b, "k").count() == 1
    assert rows(joins.null_safe_join(a, b, ["k"])) == [("k", 2, 4), (None, 1, 3)]


def test_range_lookup_edges(spark):  # JON-15
    ranges = spark.createDataFrame([(0.0, 10.0, "a"), (10.0, 35.0, "b"), (40.0, 41.0, "c")], "lo double, hi double, r string")
    facts = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 9.99, 10.0, 34.0, 35.0, 40.5, 41.0)], "x double")
    found = {r.x: r.r for r in joins.range_lookup(facts, F.col("x"), ranges, "lo", "hi", 7.0).collect()}
    assert found == {-1.0: None, 0.0: "a", 9.99: "a", 10.0: "b", 34.0: "b", 35.0: None, 40.5: "c", 41.0: None}


def test_densify_has_every_period(spark):  # JON-05
    df = spark.createDataFrame([("a", 2020, 1), ("b", 2021, 2)], "k string, year int, v int")
    assert joins.densify(df, ["k"], "year", 2020, 2021).count() == 4


def test_rank_with_ties(spark):  # WIN-01, WIN-02
    df = spark.createDataFrame([(1, 100), (2, 100), (3, 90), (4, 80)], "id int, score int").withColumn("g", F.lit(1))
    got = windows.ranked(df, ["g"], "score", ["id"], True)
    assert rows(got, "id", "rank", "dense_rank") == [(1, 1, 1), (2, 1, 1), (3, 3, 2), (4, 4, 3)]


def test_growth_example(spark):  # WIN-16
    df = spark.createDataFrame([("RO", 2021, 2000.0), ("RO", 2022, 3500.0), ("RO", 2023, 5100.0)], "c string, year int, v double")
    prev = windows.previous_period(df, ["c"], "year", ["v"])
    got = prev.select("year", columns.growth_pct(F.col("v"), F.col("v_prev"), 1).alias("g"))
    assert rows(got) == [(2021, None), (2022, 75.0), (2023, 45.7)]


def test_strict_growth_skips_gaps(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2022, 2.0)], "c string, year int, v double")
    assert rows(windows.previous_period(df, ["c"], "year", ["v"]), "year", "v_prev") == [(2020, None), (2022, 1.0)]
    assert rows(windows.previous_period(df, ["c"], "year", ["v"], True), "year", "v_prev") == [(2020, None), (2022, None)]


def test_null_rules(spark):  # PRJ-08, PRJ-11, PRJ-15
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None)], "s string, n int")
    assert columns.drop_null_rows(df).count() == 1
    assert columns.drop_null_rows(df, "all").count() == 3
    assert df.filter(F.col("s") == F.lit(None)).count() == 0
    assert df.filter(F.col("s") != "a").count() == 1


def test_bands_and_casts(spark):  # PRJ-05, PRJ-06
    df = spark.createDataFrame([("5",), ("x",), (None,)], "v string")
    cast = columns.try_cast_columns(df, {"v": "int"})
    got = cast.select("v", columns.bands(F.col("v"), [(10, "low")], "high").alias("b"))
    assert rows(got) == [(5, "low"), (None, None), (None, None)]


def test_share_needs_positive_total(spark):  # PRJ-16
    df = spark.createDataFrame([(1.0, 8.0), (1.0, 0.0), (1.0, None)], "p double, t double")
    assert rows(df.select(columns.share_pct(F.col("p"), F.col("t")))) == [(12.5,), (None,), (None,)]


def test_keep_one_policies(spark):  # PRJ-22
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "k string, at int, v string")
    assert rows(dedup.keep_one(df, ["k"], [F.col("at")]), "k", "v") == [("j", "only"), ("k", "new")]
    assert rows(dedup.keep_one(df, ["k"], [F.col("at")], "first"), "k", "v") == [("j", "only"), ("k", "old")]
    with pytest.raises(ValueError):
        dedup.require_unique(df, ["k"], "t")


def test_forced_row_is_appended_once(spark):  # SRT-04
    top = spark.createDataFrame([("A", 9), ("B", 8)], "k string, v int")
    assert ordering.with_forced_rows(top, spark.createDataFrame([("C",)], "k string"), "k").count() == 3
    assert ordering.with_forced_rows(top, spark.createDataFrame([("A",)], "k string"), "k").count() == 2


def test_explode_kinds(spark):  # COL-10
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "id int, xs array<string>")
    assert df.select(F.explode("xs")).count() == 1
    assert df.select(F.explode_outer("xs")).count() == 3


def test_order_total(spark):  # COL-08
    df = spark.createDataFrame([([("a", 1, 4500.0), ("b", 2, 150.0), ("c", 3, 30.0)],)], "items array<struct<p:string,qty:int,price:double>>")
    total = nested.fold(F.col("items"), F.lit(0.0), lambda a, x: a + x["qty"] * x["price"])
    assert df.select(total).first()[0] == 4890.0


def test_json_routing(spark):  # COL-18, COL-21
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), (None,)], "j string")
    good, bad = nested.route_json(df, "j", "a int")
    assert good.filter("parsed.a = 1").count() == 1
    assert rows(bad) == [('{"a": ',)]


def test_sorted_map(spark):
    df = spark.sql("SELECT map('b', 1, 'a', 2) AS m")
    assert df.select(F.to_json(nested.sorted_map(F.col("m")))).first()[0] == '{"a":2,"b":1}'


def test_duplicate_map_key_raises(spark):  # COL-15
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        spark.sql("SELECT map_concat(map('a', 1), map('a', 2))").collect()


def test_grades(spark):  # UDF-01..03, UDF-07
    df = spark.createDataFrame([(95.0,), (75.0,), (60.0,), (59.9,), (None,)], "s double")
    got = df.select("s", udfs.grade_udf("s"), udfs.grade_expr(F.col("s"))).collect()
    assert [r[1] for r in got] == [r[2] for r in got] == ["A", "B", "C", "F", None]


def test_group_zscore_is_per_group_not_per_batch(spark):  # UDF-04, UDF-06
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)], "k string, v double")
        got = [r.z for r in udfs.group_zscore(df, ["k"], "v", "z").orderBy("v").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == pytest.approx([-1.1619, -0.3873, 0.3873, 1.1619], abs=1e-4)


def test_ten_of_eleven_raw_orders_problem(spark):  # PIP-24
    raw = [(f"O{i}", "c", " Ann ", "books", str(10 * i), "2024-01-0%d" % (1 + i % 3), "eu") for i in range(1, 9)]
    raw += [raw[0], (None, None, None, None, None, None, None), ("O9", "c", "Bob", "books", "INVALID", "2024-01-01", "eu")]
    df = spark.createDataFrame(raw, "order_id string, customer_id string, customer string, category string, amount string, order_date string, region string")
    bronze = order_jobs.bronze_orders(df.withColumn("_ingested_at", F.current_timestamp()))
    silver = order_jobs.silver_orders(bronze)
    assert silver.count() == 8
    assert silver.select("customer", "category", "region").distinct().collect()[0] == ("Ann", "BOOKS", "EU")


def test_delay_classes(spark):  # PIP-26
    df = spark.createDataFrame([(0, 5), (30, 5), (31, 5), (121, 5), (None, 5), (3, 0)], "delay int, distance int")
    got = order_jobs.classify_delays(df)
    assert rows(got, "delay", "is_delayed", "delay_category") == [
        (0, False, "On Time"), (121, True, "Severe Delay"), (30, True, "Minor Delay"), (31, True, "Major Delay"),
    ]


def test_names(spark):  # STRF-13
    df = spark.createDataFrame([("  O'Neil-3 ",), (" 12 ",), (None,)], "n string")
    assert [r[0] for r in df.select(order_jobs.normal_name(F.col("n"))).collect()] == ["ONeil", None, None]


# --- panels on the vehicle code tables -------------------------------------------


@pytest.fixture(scope="module")
def coded_bronze(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    cells = [
        ("RO", "ELC", "2022", 3500.0, "a", early), ("RO", "ELC", "2021", 2000.0, "a", early),
        ("RO", "ELC", "2022", 3400.0, "a0", dt.datetime(2023, 1, 1)),
        ("RO", "PET", "2022", 85000.0, "a", early), ("RO", "ALT", "2022", 9999.0, "a", early),
        ("RO", "TOTAL", "2022", 95000.0, "a", early), ("RO", "TOTAL", "2021", 90000.0, "a", early),
        ("EL", "ELC", "2022", 10.0, "a", early), ("EL", "TOTAL", "2022", 100.0, "a", early),
        ("EU28", "ELC", "2022", 1.0, "a", early), ("RO", "LPG", "2022", None, "b", late),
    ]
    return spark.createDataFrame(cells, "geo string, mot_nrg string, time string, value double, source_file string, ingested_at timestamp")


def silver_of(bronze):
    return panel.conform_coded(
        bronze, refdata.FUEL_LABELS, refdata.FUEL_CATEGORIES, refdata.AGGREGATE_GEOS, "new_registrations",
        refdata.AGGREGATE_FUELS, refdata.GEO_ALIASES,
    )


def test_silver_coded(coded_bronze):  # PIP-03
    got = rows(silver_of(coded_bronze), "country_code", "year", "fuel_type_code", "fuel_category", "new_registrations")
    assert ("RO", 2022, "ELC", "Electric", 3500.0) in got  # the newer load wins
    assert ("GR", 2022, "ELC", "Electric", 10.0) in got
    assert not any(r[2] == "ALT" or r[0] == "EU28" or r[2] == "LPG" for r in got)


def test_market_share(coded_bronze):  # PIP-05..09
    gold = {(r.country_code, r.year): r for r in panel.market_share(silver_of(coded_bronze)).collect()}
    now = gold["RO", 2022]
    assert (now.ev_market_share_pct, now.ice_market_share_pct, now.ev_yoy_growth_pct) == (3.68, 89.47, 75.0)
    assert now.ev_share_yoy_change_pp == 1.46
    assert gold["RO", 2021].ev_yoy_growth_pct is None
    assert gold["GR", 2022].ice_registrations is None


def test_focus_summary(spark, coded_bronze):  # PIP-10..14
    shares = panel.market_share(silver_of(coded_bronze))
    second = spark.createDataFrame(
        [("RO", 2022, "EV sales", "BEV", 5.0), ("RO", 2022, "EV sales", "PHEV", 2.0), ("RO", 2022, "EV sales", "EV", 7.0)],
        "country_code string, year int, parameter string, powertrain string, ev_count double",
    )
    wide = panel.second_source(second, "RO", {"EV sales": "ev_sales_iea", "EV stock": "ev_stock_iea"}, ["EV"])
    got = {r.year: r for r in panel.focus_summary(shares, wide, "RO", refdata.MEMBERS).collect()}
    assert got[2022].ev_sales_iea == 7.0 and got[2022].ev_stock_iea is None
    assert got[2022].ev_share_rank == 2 and got[2022].eu_country_total == 27 and got[2022].eu_country_count == 2
    assert got[2022].vs_eu_avg_pp == round(3.68 - got[2022].eu_avg_ev_share_pct, 2)
    assert got[2021].ev_sales_iea is None


def test_silver_named(spark):  # PIP-02
    at = dt.datetime(2024, 1, 1)
    bronze = spark.createDataFrame(
        [("Romania", "Historical", "EV sales", "Cars", "BEV", 2022, "Vehicles", 5.0, "f1", at),
         ("Romania", "Historical", "EV sales", "Cars", "BEV", 2022, "Vehicles", 6.0, "f2", dt.datetime(2024, 2, 1)),
         ("Atlantis", "Historical", "EV sales", "Cars", "BEV", 2022, "Vehicles", 1.0, "f1", at),
         ("Romania", "Historical", "EV sales", "Buses", "BEV", 2022, "Vehicles", 9.0, "f1", at)],
        "region string, category string, parameter string, mode string, powertrain string, year int, unit string, value double, source_file string, ingested_at timestamp",
    )
    got = rows(panel.conform_named(bronze, refdata.REGION_CODES), "country_code", "country_name", "ev_count")
    assert got == [("RO", "Romania", 6.0), (None, "Atlantis", 1.0)]


def test_code_tables():  # PIP-04
    assert len(refdata.REGION_CODES) == 53 and len(refdata.MEMBERS) == 27
    assert set(refdata.FUEL_LABELS) == set(refdata.FUEL_CATEGORIES) and len(refdata.FUEL_LABELS) == 16
    assert refdata.stock_categories()["PET"] == "Combustion" and refdata.stock_labels()["DIE"] == "Diesel"


def test_dyadic_cells(spark):  # JON-15
    for low, high in [(0, 1), (3, 3), (5, 4), (-7, 9), (1, 1 << 40), (-(1 << 50) - 3, (1 << 50) + 5), (6, 7)]:
        got = spark.range(1).select(joins.dyadic_cells(F.lit(low).cast("bigint"), F.lit(high).cast("bigint")).alias("c")).first().c
        spans = sorted((c.cell << c.level, (c.cell + 1) << c.level) for c in got)
        assert len(spans) <= 2 * max(high - low, 2).bit_length()
        assert [a for a, _ in spans[1:]] == [b for _, b in spans[:-1]]
        assert (spans[0][0], spans[-1][1]) == (low, high) if low < high else not spans


def test_range_join(spark):  # JON-15
    import random

    rng = random.Random(2)
    ranges = [(k, a := rng.uniform(-500, 500), a + 10 ** rng.uniform(-2, 5)) for k in range(60)] + [(60, 1.0, 1.0), (61, 5.0, 4.0), (62, None, 4.0), (63, 2.0, 3.0), (63, 2.0, 3.0)]
    values = [rng.uniform(-600, 900) for _ in range(300)] + [1.0, 2.0, 3.0, None]
    table = spark.createDataFrame(ranges, "k int, low double, high double")
    found = joins.range_join(spark.createDataFrame([(v,) for v in values], "v double"), F.col("v"), table, "low", "high", 0.5)
    want = [(v, k) for v in values for k, a, b in ranges if v is not None and a is not None and a <= v < b]
    assert rows(found, "v", "k") == sorted(want, key=repr)
    assert joins.range_join(found, F.col("v"), table.limit(0).withColumnsRenamed({"k": "k2", "low": "l2", "high": "h2"}), "l2", "h2", 1.0).count() == 0


def test_range_sums(spark):  # JON-15
    """Totals of ranges against brute force: equal bounds and values, copies of a range, null measures, empty ranges."""
    import random

    rng = random.Random(3)
    ranges = [(k, a := float(rng.randrange(-50, 50)), a + rng.randrange(0, 60)) for k in range(80)]
    ranges += [(80, 1.0, 1.0), (81, 5.0, 4.0), (82, None, 4.0), (83, 2.0, 3.0), (83, 2.0, 3.0), (84, 1000.0, 2000.0), (85, 2e4, 3e4)]
    facts = [(float(rng.randrange(-60, 120)) / 2, rng.choice([None, rng.randrange(100)])) for _ in range(400)] + [(None, 5), (1500.0, None), (-0.0, 7)]
    table = spark.createDataFrame(ranges, "k int, low double, high double")
    found = joins.range_sums(spark.createDataFrame(facts, "v double, x int"), F.col("v"), table, "low", "high", {"n": F.lit(1), "s": F.col("x").cast("decimal(9,2)")})
    want = []
    for k, a, b in ranges:
        held = [x for v, x in facts if v is not None and a is not None and a <= v < b]
        if held:
            known = [x for x in held if x is not None]
            want.append((k, a, b, len(held), sum(known) if known else None))
    assert rows(found.withColumn("s", F.col("s").cast("int"))) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="whole numbers"):
        joins.range_sums(table, F.col("low"), table, "low", "high", {"s": F.col("high")})


def test_range_sums_makes_no_pairs(spark):  # JON-15
    """Wide ranges over many facts: some 37 billion pairs, which only totals without pairs get through."""
    facts, ranges = spark.range(2_000_000).select(F.col("id").alias("v")), spark.range(20_000).select("id", (F.col("id") * 3).alias("low"), (F.col("id") + 1_900_000).alias("high"))
    got = joins.range_sums(facts, F.col("v"), ranges, "low", "high", {"n": F.lit(1)})
    assert got.agg(F.sum("n")).first()[0] == sum(k + 1_900_000 - 3 * k for k in range(20_000))


def test_approx_distinct_error(spark, tmp_path):  # AGG-07
    """A type without users has no error; no sketch is grouped by user."""
    from sheafwork.queries import REGISTRY

    spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", None), (None, 7)], "event_type string, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = REGISTRY["approx_distinct_error"].run(spark, str(tmp_path))
    assert rows(got) == sorted([("a", 2, True), ("b", 0, True), (None, 1, True)], key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "approx_count_distinct" in x and "keys=[event_type" in x and "user_id#" in x.split("functions=")[0]]
