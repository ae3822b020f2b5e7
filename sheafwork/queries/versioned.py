"""Versioned-table and file-layout queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import buckets, versions
from sheafwork.queries.registry import big, money, query, real, table
from sheafwork.sinks import layout


def customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", big("c_nationkey").alias("c_nationkey"), real(money("c_acctbal")).alias("balance")
    )


BASE = """base AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey::BIGINT AS c_nationkey,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM customer)"""


@query("update_where", "VER-01", f"""WITH {BASE}
SELECT c_custkey, c_name, CASE WHEN balance < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS c_mktsegment, c_nationkey,
       CASE WHEN balance < 0 THEN 0.0::DOUBLE ELSE balance END AS balance FROM base""")
def update_where(spark, sf):
    return versions.update_where(
        customers(spark, sf), F.col("balance") < 0, {"c_mktsegment": F.lit("DEBTOR"), "balance": F.lit(0)}
    )


@query("delete_where", "VER-02", f"""WITH {BASE}
SELECT * FROM base WHERE NOT coalesce(nullif(c_mktsegment, 'MACHINERY') = 'BUILDING', false)""")
def delete_where(spark, sf):
    """A null condition keeps the row."""
    return versions.delete_where(
        customers(spark, sf), F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")) == "BUILDING"
    )


# The merge source: debtors get a new segment; every supplier arrives as a new row.
def merge_source(spark, sf):
    changed = customers(spark, sf).filter(F.col("balance") < 0).withColumn("c_mktsegment", F.lit("DEBTOR"))
    added = table(spark, sf, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("SUPPLIER").alias("c_mktsegment"),
        big("s_nationkey").alias("c_nationkey"), real(money("s_acctbal")).alias("balance"),
    )
    return changed.unionByName(added)


MERGE = f"""{BASE},
src AS (SELECT c_custkey, c_name, 'DEBTOR' AS c_mktsegment, c_nationkey, balance FROM base WHERE balance < 0
  UNION ALL SELECT -s_suppkey - 1, s_name, 'SUPPLIER', s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) FROM supplier),
merged AS (SELECT * FROM src UNION ALL SELECT * FROM base WHERE c_custkey NOT IN (SELECT c_custkey FROM src))"""


@query("upsert", "VER-03", f"WITH {MERGE} SELECT * FROM merged")
def upsert(spark, sf):
    return versions.upsert(customers(spark, sf), merge_source(spark, sf), ["c_custkey"])


@query("upsert_columns", "VER-04", f"""WITH {MERGE}
SELECT coalesce(b.c_custkey, s.c_custkey) AS c_custkey, coalesce(b.c_name, s.c_name) AS c_name,
       CASE WHEN b.c_custkey IS NULL THEN NULL WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment,
       coalesce(b.c_nationkey, s.c_nationkey) AS c_nationkey, b.balance AS balance
FROM base b FULL JOIN src s ON b.c_custkey = s.c_custkey""")
def upsert_columns(spark, sf):
    return versions.upsert(
        customers(spark, sf), merge_source(spark, sf), ["c_custkey"], update=["c_mktsegment"], insert=["c_name", "c_nationkey"]
    )


@query("change_feed", "VER-09", f"""WITH {MERGE}, after AS (SELECT * FROM merged WHERE c_nationkey <> 7)
SELECT 'insert' AS change_type, a.* FROM after a WHERE c_custkey NOT IN (SELECT c_custkey FROM base)
UNION ALL SELECT 'delete', b.* FROM base b WHERE c_custkey NOT IN (SELECT c_custkey FROM after)
UNION ALL SELECT 'update_preimage', b.* FROM base b JOIN after a ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment
UNION ALL SELECT 'update_postimage', a.* FROM base b JOIN after a ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment""")
def change_feed(spark, sf):
    """Changes between a table and its merged state with one nation removed."""
    before = customers(spark, sf)
    after = versions.delete_where(versions.upsert(before, merge_source(spark, sf), ["c_custkey"]), F.col("c_nationkey") == 7)
    return versions.change_feed(before, after, ["c_custkey"])


@query("change_feed_buckets", "VER-09 VER-03", f"""WITH {BASE}, few AS (SELECT * FROM base WHERE c_custkey % 97 = 0)
SELECT 'update_preimage' AS change_type, * FROM few
UNION ALL SELECT 'update_postimage', c_custkey, c_name, 'MOVED', c_nationkey, balance FROM few
UNION ALL SELECT 'insert', -s_suppkey - 1, s_name, 'SUPPLIER', s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE)
FROM supplier WHERE s_suppkey % 11 = 0""")
def change_feed_buckets(spark, sf):
    """Changes between two tables by buckets, one of which went on by a merge; only buckets with other digests are joined."""
    base = customers(spark, sf)
    old, new = workspace.fresh(spark, "state"), workspace.fresh(spark, "state")
    n = max(64, base.count() // 200_000)
    for path in (old, new):
        buckets.create(base, path, ["c_custkey"], n)
    moved = base.filter(F.col("c_custkey") % 97 == 0).withColumn("c_mktsegment", F.lit("MOVED"))
    added = merge_source(spark, sf).filter((F.col("c_custkey") < 0) & ((-F.col("c_custkey") - 1) % 11 == 0))
    buckets.merge(spark, new, moved.unionByName(added), ["c_custkey"], [])
    return buckets.changes(spark, old, new, ["c_custkey"])


def _day(n):
    return dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)


def history_table(spark, sf):
    """Four versions: create, update, delete, merge; one per day."""
    t = versions.VersionedTable(spark, workspace.fresh(spark, "versions"))
    t.create(customers(spark, sf), _day(1))
    t.commit(versions.update_where(t.read(), F.col("balance") < 0, {"balance": F.lit(0)}), "UPDATE", _day(2))
    t.commit(versions.delete_where(t.read(), F.col("c_nationkey") == 7), "DELETE", _day(3))
    t.commit(versions.upsert(t.read(), merge_source(spark, sf), ["c_custkey"]), "MERGE", _day(4))
    return t


_STATES = f"""{MERGE}, v1 AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, greatest(balance, 0) AS balance FROM base),
v2 AS (SELECT * FROM v1 WHERE c_nationkey <> 7),
v3 AS (SELECT * FROM src UNION ALL SELECT * FROM v2 WHERE c_custkey NOT IN (SELECT c_custkey FROM src))"""


@query("time_travel", "VER-05 VER-06", f"""WITH {_STATES}
SELECT 'v1' AS state, * FROM v1 UNION ALL SELECT 'day3', * FROM v2 UNION ALL SELECT 'newest', * FROM v3""")
def time_travel(spark, sf):
    t = history_table(spark, sf)
    states = {"v1": t.read(1), "day3": t.read_at(_day(3) + dt.timedelta(hours=5)), "newest": t.read()}
    out = None
    for name, df in states.items():
        one = df.withColumn("state", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("version_history", "VER-07 VER-08 VER-13", f"""WITH {_STATES}
SELECT 0::BIGINT AS version, 'CREATE' AS operation, (SELECT count(*) FROM base) AS n_rows, '2024-01-01' AS day, true AS expired
UNION ALL SELECT 1, 'UPDATE', (SELECT count(*) FROM v1), '2024-01-02', true
UNION ALL SELECT 2, 'DELETE', (SELECT count(*) FROM v2), '2024-01-03', true
UNION ALL SELECT 3, 'MERGE', (SELECT count(*) FROM v3), '2024-01-04', false
UNION ALL SELECT 4, 'RESTORE 0', (SELECT count(*) FROM base), '2024-01-05', false""")
def version_history(spark, sf):
    """History after a restore, with the versions a 24 hour retention would remove."""
    t = history_table(spark, sf)
    t.restore(0, _day(5))
    gone = t.expired(_day(5), 24).select("version", F.lit(True).alias("gone"))
    return t.history().join(gone, "version", "left").select(
        "version", "operation", "n_rows", F.date_format("committed_at", "yyyy-MM-dd").alias("day"),
        F.coalesce("gone", F.lit(False)).alias("expired"),
    )


@query("schema_evolution", "VER-10", """
SELECT c_custkey AS id, c_name AS name, NULL::BIGINT AS nationkey FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def schema_evolution(spark, sf):
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), big("s_nationkey").alias("nationkey")
    )
    return versions.evolve(old, new, merge_schema=True)


LINES = """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem"""


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@query("compaction", "VER-11 VER-14", "SELECT count(*) AS n, true AS fewer, true AS same_rows FROM lineitem")
def compaction(spark, sf):
    """Many small files rewritten; the report compares both folders."""
    many, few = workspace.fresh(spark, "many"), workspace.fresh(spark, "few")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _lines(spark, sf).repartition(3 * partitions).write.parquet(many)
    stored = spark.read.parquet(many)
    layout.compact(stored, few)
    files_before = layout.file_report(spark, many).select("n_files").scalar()
    files_after = layout.file_report(spark, few).select("n_files").scalar()
    rows_before = stored.agg(F.count(F.lit(1))).scalar()
    return spark.read.parquet(few).agg(F.count(F.lit(1)).alias("n")).select(
        "n", (files_after < files_before).alias("fewer"), (F.col("n") == rows_before).alias("same_rows")
    )


@query("zorder_layout", "VER-12", LINES)
def zorder_layout(spark, sf):
    path = workspace.fresh(spark, "zorder")
    rows = _lines(spark, sf)
    layout.z_order(rows, ["l_partkey", "l_suppkey"], path, layout.files_for(rows, at_least=16))
    return spark.read.parquet(path)


@query("zorder_mixed_types", "VER-12", """
SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders""")
def zorder_mixed_types(spark, sf):
    """Orders clustered by a text and a date."""
    path = workspace.fresh(spark, "zorder")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    layout.z_order(rows, ["o_orderpriority", "day"], path, layout.files_for(rows, at_least=16))
    return spark.read.parquet(path)


@query("zorder_skipping", "VER-12")
def zorder_skipping(spark, sf):
    """Value ranges per file after clustering on two columns."""
    path = workspace.fresh(spark, "zorder")
    rows = _lines(spark, sf)
    layout.z_order(rows, ["l_partkey", "l_suppkey"], path, layout.files_for(rows, at_least=16))
    return layout.file_ranges(spark.read.parquet(path), ["l_partkey", "l_suppkey"]).drop("file")
