"""Streaming queries; each drains its input and returns the stored result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork import workspace
from sheafwork.operators import buckets, skew
from sheafwork.queries.registry import REGISTRY, big, money, query, real, table
from sheafwork.streaming import aggregates, io, timers
from sheafwork.streaming.medallion import Medallion, upsert_stream


def table_stream(spark, sf, name):
    """A given table as a stream. The glob fits a single file as well as a folder of files."""
    return io.file_stream(spark, f"{sf}/{name}.parquet*", table(spark, sf, name).schema)


def events(spark, sf):
    return io.event_time(table_stream(spark, sf, "events"), "ts")


def closing_row(spark, sf):
    """A one-row stream far behind the last event, which moves the watermark past all windows."""
    source = table(spark, sf, "events")
    far = source.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts"))
    row = far.select(*["ts" if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema.fields])
    folder = workspace.fresh(spark, "closing")
    row.write.parquet(folder)
    return io.event_time(io.file_stream(spark, folder, source.schema), "ts")


def closed_events(spark, sf):
    """Events, and the closing row, told apart by the column ``closing``."""
    return events(spark, sf).withColumn("closing", F.lit(False)).unionByName(
        closing_row(spark, sf).withColumn("closing", F.lit(True))
    )


def stored(spark, stream, name):
    """Append-mode result of a drained stream."""
    folder = workspace.fresh(spark, name)
    io.drain(io.to_files(stream, f"{folder}/rows"), f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def updated(spark, stream, name, keys):
    """Latest value per key of a drained update-mode stream."""
    folder = workspace.fresh(spark, name)
    io.drain(io.each_batch(stream, io.batch_writer(f"{folder}/rows"), "update"), f"{folder}/checkpoint")
    return io.latest_state(spark.read.parquet(f"{folder}/rows"), keys)


def _clock(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


_TOTALS = "count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total"


def _totals():
    return [F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total")]


@query("stream_tumbling", "STR-01 STR-04 STR-05 STR-08 STR-09", f"""
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, {_TOTALS} FROM events GROUP BY 1, 2""")
def stream_tumbling(spark, sf):
    """Five-minute windows in append mode; a closing row lets the last ones out."""
    out = aggregates.windowed(closed_events(spark, sf), "ts", "5 minutes", ["event_type", "closing"], _totals(), "10 minutes")
    return stored(spark, out, "tumbling").filter(~F.col("closing")).select(
        _clock("window_start").alias("window_start"), "event_type", "n", real("total").alias("total")
    )


@query("stream_table_sink", "STR-06 STR-08 SNK-01 SRC-08", REGISTRY["stream_tumbling"].sql)
def stream_table_sink(spark, sf):
    """Five-minute windows appended to a catalog table, in two runs of one checkpoint."""
    folder = workspace.fresh(spark, "table_sink")
    name = "windows_" + folder.rsplit("-", 1)[1]
    for source in ("events", "closing"):
        # The closing row lands after the first run and lets the last windows out.
        rows = table(spark, sf, "events").withColumn("closing", F.lit(False))
        if source == "closing":
            far = (F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")
            rows = rows.agg(far).withColumn("closing", F.lit(True)).select(
                *["ts" if f.name == "ts" else "closing" if f.name == "closing" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
            )
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = io.event_time(io.file_stream(spark, f"{folder}/in", rows.schema), "ts")
        out = aggregates.windowed(stream, "ts", "5 minutes", ["event_type", "closing"], _totals(), "10 minutes")
        io.drain_to_table(out, name, f"{folder}/checkpoint", f"{folder}/table")
    got = spark.table(name).filter(~F.col("closing"))
    return got.select(_clock("window_start").alias("window_start"), "event_type", "n", real("total").alias("total"))


@query("stream_complete", "STR-04 STR-06", f"SELECT event_type, {_TOTALS} FROM events GROUP BY 1")
def stream_complete(spark, sf):
    """Totals by type in complete mode: every batch delivers the whole result."""
    folder = workspace.fresh(spark, "complete")
    out = table_stream(spark, sf, "events").groupBy("event_type").agg(*_totals())
    io.drain(io.each_batch(out, io.whole_results(f"{folder}/rows"), "complete"), f"{folder}/checkpoint")
    return io.current_result(spark, f"{folder}/rows").withColumn("total", real("total"))


@query("stream_sliding", "STR-10", """
WITH w AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * k) AS s, value FROM events, (VALUES (0), (1)) v(k))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM w GROUP BY 1, 2""")
def stream_sliding(spark, sf):
    """Hour windows every half hour in update mode."""
    out = aggregates.windowed(events(spark, sf), "ts", "60 minutes", [], _totals(), "10 minutes", "30 minutes")
    rows = updated(spark, out, "sliding", ["window_start", "window_end"])
    return rows.select(
        _clock("window_start").alias("window_start"), _clock("window_end").alias("window_end"), (real("total") / F.col("n")).alias("mean")
    )


@query("stream_dedup", "STR-12 STR-01", "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def stream_dedup(spark, sf):
    """The event stream merged with a second delivery of itself; one copy stays."""
    twice = events(spark, sf).unionByName(events(spark, sf))
    out = aggregates.unique_events(twice, "ts", ["event_id"], "1 day")
    return stored(spark, out, "unique").select("event_id", "user_id", "event_type", _clock("ts").alias("at"))


@query("stream_enrich", "STR-11 JON-19", """
SELECT o_orderkey, c_name, c_mktsegment, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS DOUBLE) AS doubled
FROM orders LEFT JOIN customer ON o_custkey = c_custkey + 100""")
def stream_enrich(spark, sf):
    """The order stream with customers under shifted keys, so that some orders find none."""
    customers = table(spark, sf, "customer").select((F.col("c_custkey") + 100).alias("o_custkey"), "c_name", "c_mktsegment")
    orders = table_stream(spark, sf, "orders").withColumn("doubled", real(money("o_totalprice") * 2))
    hot = skew.measured_hot(table(spark, sf, "orders"), ["o_custkey"])
    out = aggregates.enrich(orders, customers, "o_custkey", spread_by=["o_orderkey"], hot=hot).select("o_orderkey", "c_name", "c_mktsegment", "doubled")
    return stored(spark, out, "enriched")


@query("stream_join", "STR-18", """
SELECT o_orderkey AS orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 60 DAY GROUP BY 1""")
def stream_join(spark, sf):
    """Order stream joined to the stream of lines shipped within sixty days of the order."""
    orders = io.event_time(table_stream(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    lines = io.event_time(table_stream(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_quantity"), "l_shipdate")
    out = aggregates.join_streams(
        orders, lines, "o_orderdate", "l_shipdate", F.col("o_orderkey") == F.col("l_orderkey"), "60 DAYS", "1 day",
        spread_by=["l_partkey", "l_linenumber"], hot=skew.measured_hot(table(spark, sf, "lineitem"), ["l_orderkey"]), on=("o_orderkey", "l_orderkey"),
    )
    with io.rows_only(spark):
        rows = stored(spark, out.select("o_orderkey", big("l_quantity").alias("qty")), "joined")
    return rows.groupBy(F.col("o_orderkey").alias("orderkey")).agg(F.count(F.lit(1)).alias("n_lines"), F.sum("qty").alias("qty"))


@query("stream_sessions", "STR-19", """
WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM s GROUP BY user_id, sid""")
def stream_sessions(spark, sf):
    out = aggregates.sessions(closed_events(spark, sf), "ts", "6 hours", ["user_id", "closing"], _totals(), "1 hour")
    return stored(spark, out, "sessions").filter(~F.col("closing")).select(
        "user_id", _clock("session_start").alias("session_start"), "n", real("total").alias("total")
    )


_SESSIONS = REGISTRY["stream_sessions"].sql


@query("stream_timed_sessions", "STR-19 STR-07", _SESSIONS)
def stream_timed_sessions(spark, sf):
    """Sessions closed by timers while thirds of the month land one after another, each drained with the same checkpoint."""
    source = table(spark, sf, "events")
    first, last = source.agg(F.min("ts"), F.max("ts")).first()
    folder = workspace.fresh(spark, "timed_sessions")
    schema = T.StructType([*source.schema.fields, T.StructField("closing", T.BooleanType())])
    rows = source.withColumn("closing", F.lit(False))
    edges = [first, *[first + (last - first) * k / 3 for k in (1, 2)], last + dt.timedelta(days=1)]
    for k in range(3):
        part = rows.filter((F.col("ts") >= F.lit(edges[k])) & (F.col("ts") < F.lit(edges[k + 1])))
        if k == 2:
            far = (F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")
            part = part.unionByName(source.agg(far).withColumn("closing", F.lit(True)), allowMissingColumns=True)
        part.write.mode("append").parquet(f"{folder}/in")
        stream = io.event_time(io.file_stream(spark, f"{folder}/in", schema), "ts")
        out = timers.timed_sessions(stream, ["user_id", "closing"], "ts", money("value") * 100, 6 * 3600, "1 hour", groups=512)
        io.drain(io.to_files(out, f"{folder}/out"), f"{folder}/checkpoint")
    got = spark.read.schema(out.schema).parquet(f"{folder}/out").filter(~F.col("closing"))
    return got.select("user_id", _clock("session_start").alias("session_start"), "n", real((F.col("cents") / 100).cast("decimal(18,2)")).alias("total"))


@query("stream_running_state", "STR-19 STR-06", """
SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n_events, CAST(sum(CAST(round(CAST(value AS DECIMAL(18,2)) * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM events GROUP BY 1""")
def stream_running_state(spark, sf):
    out = aggregates.running_totals(
        events(spark, sf), F.col("user_id"), F.col("ts"), money("value") * 100, ["event_id"],
        parts=1, hot=skew.measured_hot(table(spark, sf, "events"), ["user_id"]),
    )
    pieces = updated(spark, out, "running", ["key", "part"])
    return aggregates.merge_totals(pieces).withColumn("last_at", _clock("last_at"))


@query("stream_upsert", "STR-16 VER-03", """
SELECT c_custkey, CASE WHEN o.amount IS NULL THEN c_mktsegment ELSE 'ACTIVE' END AS c_mktsegment, o.amount AS last_amount
FROM customer LEFT JOIN (SELECT o_custkey, max_by(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), (o_orderdate, o_orderkey)) AS amount
FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")
def stream_upsert(spark, sf):
    """The order stream merged into the customer table: newest order per customer wins."""
    base = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.lit(None).cast("double").alias("last_amount"),
                                               F.lit(None).cast("timestamp_ntz").alias("ordered_at"), F.lit(None).cast("bigint").alias("orderkey"))
    folder = workspace.fresh(spark, "stream_upsert")
    target = f"{folder}/table"
    # About 200 000 customers a bucket.
    buckets.create(base, target, ["c_custkey"], max(8, base.count() // 200_000))
    changes = table_stream(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.lit("ACTIVE").alias("c_mktsegment"), real(money("o_totalprice")).alias("last_amount"),
        F.col("o_orderdate").alias("ordered_at"), F.col("o_orderkey").alias("orderkey"),
    )
    upsert_stream(changes, target, ["c_custkey"], ["ordered_at", "orderkey"], f"{folder}/checkpoint")
    return buckets.read(spark, target).drop("ordered_at", "orderkey")


@query("stream_medallion", "STR-13 STR-14 STR-15 STR-02 STR-07", """
SELECT c_mktsegment AS segment, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * 2) AS DOUBLE) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 14 <> 0 GROUP BY 1""")
def stream_medallion(spark, sf):
    """Raw orders with copies and missing customers, streamed through three layers."""
    raw = table_stream(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 14 != 0, F.col("o_custkey")).alias("custkey"),
        F.lit(2).alias("qty"), money("o_totalprice").cast("string").alias("unit_price"), F.col("o_orderdate").alias("event_time"),
    )
    flow = Medallion(spark, workspace.fresh(spark, "medallion"))
    flow.bronze(raw.unionByName(raw.filter(F.col("order_id").endswith("3"))))
    segments = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    flow.silver(
        raw.schema, "event_time", ["order_id"],
        {"customer": F.col("custkey").isNotNull(), "price": F.col("unit_price").try_cast("double") > 0},
        segments, "custkey", {"amount": F.col("qty") * F.col("unit_price").cast("decimal(18,2)")}, "1 day",
    )
    silver = T.StructType([T.StructField("segment", T.StringType()), T.StructField("amount", spark.read.parquet(flow.path("silver")).schema["amount"].dataType)])
    gold = flow.gold(silver, ["segment"], [F.count(F.lit(1)).alias("n_orders"), F.sum("amount").alias("revenue")])
    return gold.withColumn("revenue", real("revenue"))


@query("stream_restart", "STR-07 STR-17", "SELECT 'first' AS run, count(*) AS input_rows FROM events UNION ALL SELECT 'second', 0")
def stream_restart(spark, sf):
    """The same query drained twice with one checkpoint: the second run reads nothing."""
    folder = workspace.fresh(spark, "restart")
    out = None
    for run in ("first", "second"):
        log = io.drain_logged(spark, io.to_files(events(spark, sf).select("event_id"), f"{folder}/rows"), f"{folder}/checkpoint")
        rows = log.agg(F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"))
        one = rows.select(F.lit(run).alias("run"), big("input_rows").alias("input_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_rescue", "STR-02", """
SELECT event_id, event_type, '{"extra":"' || user_id || '"}' AS rescued FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, event_type, NULL FROM events WHERE event_id % 3 <> 0""")
def stream_rescue(spark, sf):
    """JSON rows of which some carry an unknown field; the field is kept as JSON."""
    text = F.to_json(F.struct("event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("extra")))
    raw = table_stream(spark, sf, "events").select(text.alias("payload"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    folder = workspace.fresh(spark, "rescue")
    write = io.batch_writer(f"{folder}/rows")
    io.drain(io.each_batch(raw, lambda b, i: write(io.check_columns(b, "payload", schema, "rescue"), i)), f"{folder}/checkpoint")
    return io.stored_batches(spark, f"{folder}/rows").select("event_id", "event_type", F.col("_rescued").alias("rescued"))
