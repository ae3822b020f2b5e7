"""Streams: same answer as batch, restarts, late rows, copies across batches."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork import workspace
from sheafwork.operators import buckets, skew
from sheafwork.streaming import aggregates, io, timers
from sheafwork.streaming.medallion import Medallion, upsert_stream
from tests.conftest import rows

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("region", T.StringType()), T.StructField("amount", T.LongType()),
     T.StructField("at", T.TimestampType())]
)


def land(folder, number, events):
    """One JSON file per chunk, with increasing modification times."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    path.write_text("\n".join(json.dumps(dict(zip(SCHEMA.names, e))) for e in events))
    os.utime(path, (1_700_000_000 + number * 10,) * 2)


def chunks(spark, folder, per_trigger=1):
    return io.file_stream(spark, str(folder), SCHEMA, "json", per_trigger)


def minute(m):
    return (dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=m)).isoformat()


EVENTS = [
    [(1, "n", 10, minute(0)), (2, "s", 20, minute(1)), (3, "n", 30, minute(6))],
    [(4, "n", 40, minute(7)), (5, "s", 50, minute(11)), (3, "n", 30, minute(6))],
    [(6, "n", 60, minute(40)), (7, "s", 5, minute(12))],
    [(9, "n", 1, minute(90))],
    # Behind the watermark (minute 30) that the batch before this one ran with: dropped.
    [(8, "n", 99, minute(14))],
]


@pytest.fixture
def landed(tmp_path):
    for i, chunk in enumerate(EVENTS):
        land(tmp_path / "in", i, chunk)
    return tmp_path / "in"


def tumbling(spark, landed):
    return aggregates.windowed(
        chunks(spark, landed), "at", "5 minutes", ["region"],
        [F.count("*").alias("n"), F.sum("amount").alias("total")], "10 minutes",
    )


def test_tumbling_append_drops_late_rows(spark, landed, tmp_path):  # STR-08, STR-09
    progress = io.drain_logged(spark, io.to_files(tumbling(spark, landed), str(tmp_path / "out")), str(tmp_path / "cp"))
    got = rows(spark.read.parquet(str(tmp_path / "out")).select(F.date_format("window_start", "HH:mm").alias("w"), "region", "n", "total"))
    assert got == [
        ("10:00", "n", 1, 10), ("10:00", "s", 1, 20), ("10:05", "n", 3, 100), ("10:10", "s", 2, 55), ("10:40", "n", 1, 60),
    ]
    assert progress.agg(F.sum("dropped_rows")).first()[0] == 1
    assert progress.agg(F.sum("input_rows")).first()[0] == sum(map(len, EVENTS))


def test_update_mode_equals_batch(spark, landed, tmp_path):  # STR-10, STR-15
    # No row is later than the delay here, so the stream sees what batch sees.
    out = aggregates.windowed(chunks(spark, landed), "at", "10 minutes", ["region"], [F.sum("amount").alias("total")], "5 hours", "5 minutes")
    io.drain(io.each_batch(out, io.batch_writer(str(tmp_path / "out")), "update"), str(tmp_path / "cp"))
    latest = io.latest_state(spark.read.parquet(str(tmp_path / "out")), ["window_start", "window_end", "region"])
    batch = spark.read.schema(SCHEMA).json(str(landed)).groupBy(F.window("at", "10 minutes", "5 minutes").alias("w"), "region").agg(F.sum("amount").alias("total"))
    assert rows(latest, "window_start", "region", "total") == rows(batch.select("w.start", "region", "total"))


def test_copies_in_later_batches_are_dropped(spark, landed, tmp_path):  # STR-12
    land(landed, 8, [(1, "n", 10, minute(0))] * 20)
    out = aggregates.unique_events(chunks(spark, landed), "at", ["id"], "5 hours")
    io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(i,) for i in range(1, 10)]


def test_late_copy_does_not_hide_a_timely_one(spark, tmp_path):  # STR-12
    land(tmp_path / "in", 0, [(1, "n", 1, minute(200))])
    land(tmp_path / "in", 1, [(2, "n", 1, minute(201))])
    land(tmp_path / "in", 2, [(7, "n", 1, minute(0)), (7, "n", 1, minute(202))])
    out = aggregates.unique_events(chunks(spark, tmp_path / "in"), "at", ["id"], "10 minutes")
    io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(1,), (2,), (7,)]


def test_progress_of_more_batches_than_spark_remembers(spark, landed, tmp_path):  # STR-17
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        log = io.drain_logged(spark, io.to_files(chunks(spark, landed), str(tmp_path / "out")), str(tmp_path / "cp"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert log.agg(F.sum("input_rows")).first()[0] == sum(map(len, EVENTS))


def test_two_feeds_into_one_target(spark, tmp_path):  # STR-13, STR-16
    table = workspace.fresh(spark, "up")
    buckets.create(spark.createDataFrame([], "id long, amount long"), table, ["id"], 4)
    for feed in (1, 2):
        land(tmp_path / f"in{feed}", 0, [(feed, "n", feed, minute(0))])
        stream = chunks(spark, tmp_path / f"in{feed}")
        upsert_stream(stream.select("id", "amount"), table, ["id"], ["amount"], workspace.fresh(spark, "cp"))
        io.drain(io.each_batch(stream, io.batch_writer(str(tmp_path / "out"))), str(tmp_path / f"cp{feed}"))
    assert rows(buckets.read(spark, table)) == [(1, 1), (2, 2)]
    assert rows(io.stored_batches(spark, str(tmp_path / "out")), "id") == [(1,), (2,)]


def test_column_that_a_later_batch_adds(spark, tmp_path):  # STR-02
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    write = io.batch_writer(str(tmp_path / "out"))
    for i, text in enumerate(('{"a": 1}', '{"a": 2, "b": "x"}')):
        write(io.check_columns(spark.createDataFrame([(text,)], "j string"), "j", schema, "addNewColumns"), i)
    assert rows(io.stored_batches(spark, str(tmp_path / "out")), "a", "b") == [(1, None), (2, "x")]


def test_restart_reads_only_new_files(spark, landed, tmp_path):  # STR-02, STR-07
    def run():
        io.drain(io.to_files(chunks(spark, landed), str(tmp_path / "out")), str(tmp_path / "cp"))
        return spark.read.parquet(str(tmp_path / "out")).count()

    n = sum(map(len, EVENTS))
    assert run() == n and run() == n
    land(landed, 9, [(10, "n", 1, minute(91))])
    assert run() == n + 1


def test_replayed_batch_is_stored_once(spark, tmp_path):  # STR-13
    write = io.batch_writer(str(tmp_path / "out"))
    batch = spark.range(5)
    write(batch, 0)
    write(batch, 1)
    write(batch, 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


@pytest.mark.parametrize("parts", [1, 3])
def test_enrich_keeps_the_stream_side(spark, landed, tmp_path, parts):  # STR-11
    static = spark.createDataFrame([("n", "North")], "region string, label string")
    out = aggregates.enrich(chunks(spark, landed), static, "region", spread_by=["id"], parts=parts)
    io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 10 and got.filter("label IS NULL").count() == 3
    with pytest.raises(ValueError):
        aggregates.enrich(chunks(spark, landed), static, "region", "right")


def test_only_hot_static_rows_are_copied(spark, landed, tmp_path):  # STR-11
    static = spark.createDataFrame([("n", "North"), ("s", "South"), ("w", "West")], "region string, label string")
    hot = spark.createDataFrame([("n", 4)], "region string, _parts int")
    copies = aggregates._copied(static, "region", hot, 1, "_part")
    assert rows(copies.groupBy("region").count()) == [("n", 4), ("s", 1), ("w", 1)]
    plain = aggregates.enrich(chunks(spark, landed), static, "region")
    spread = aggregates.enrich(chunks(spark, landed), static, "region", spread_by=["id"], hot=hot)
    got = {}
    for name, out in (("plain", plain), ("spread", spread)):
        io.drain(io.to_files(out, str(tmp_path / name)), str(tmp_path / f"cp_{name}"))
        got[name] = rows(spark.read.parquet(str(tmp_path / name)), "id", "region", "amount", "label")
    assert got["plain"] == got["spread"] and len(got["plain"]) == 10


def test_hot_keys_of_a_stream_join(spark, tmp_path):  # STR-18
    land(tmp_path / "a", 0, [(i, "x", 1, minute(0)) for i in range(3)])
    land(tmp_path / "b", 0, [(1, "x", n, minute(n % 10)) for n in range(60)] + [(2, "x", 7, minute(30)), (0, "x", 9, minute(1))])
    hot = skew.measured_hot(spark.read.schema(SCHEMA).json(str(tmp_path / "b")), ["id"], 20)
    assert rows(hot) == [(1, 3)]
    left = chunks(spark, tmp_path / "a").select(F.col("id").alias("lid"), F.col("at").alias("lat"))
    right = chunks(spark, tmp_path / "b").select("id", "amount", "at")
    match = F.col("lid") == F.col("id")
    out = aggregates.join_streams(left, right, "lat", "at", match, "10 MINUTES", "1 hour", ["amount"], hot=hot, on=("lid", "id"))
    io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "lid", "amount") == sorted([(1, n) for n in range(60)] + [(0, 9)], key=repr)
    with pytest.raises(ValueError):
        aggregates.join_streams(left, right, "lat", "at", match, "10 MINUTES", "1 hour", ["amount"], hot=hot)


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_join_within_time(spark, tmp_path, parts):  # STR-18
    land(tmp_path / "a", 0, [(1, "x", 1, minute(0)), (2, "x", 1, minute(0))])
    land(tmp_path / "b", 0, [(1, "x", 5, minute(3)), (2, "x", 7, minute(30)), (1, "x", 9, minute(-1))])
    left = chunks(spark, tmp_path / "a").select(F.col("id").alias("lid"), F.col("at").alias("lat"))
    right = chunks(spark, tmp_path / "b").select("id", "amount", "at")
    out = aggregates.join_streams(left, right, "lat", "at", F.col("lid") == F.col("id"), "10 MINUTES", "1 hour", ["amount"], parts)
    io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "lid", "amount") == [(1, 5)]


def test_stream_join_without_empty_batches(spark, tmp_path):  # STR-18
    """Each delivery takes one batch; obsolete state goes with the next rows, and later matches are found."""
    def deliver(n, a, b):
        land(tmp_path / "a", n, a)
        land(tmp_path / "b", n, b)
        left = chunks(spark, tmp_path / "a", None).select(F.col("id").alias("lid"), F.col("at").alias("lat"))
        right = chunks(spark, tmp_path / "b", None).select("id", "amount", "at")
        out = aggregates.join_streams(left, right, "lat", "at", F.col("lid") == F.col("id"), "10 MINUTES", "20 minutes")
        log = io.drain_logged(spark, io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
        return log.count(), rows(spark.read.parquet(str(tmp_path / "out")), "lid", "amount")

    kept = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    with io.rows_only(spark):
        assert deliver(0, [(1, "x", 1, minute(0)), (2, "x", 1, minute(60))], [(1, "x", 5, minute(3)), (9, "x", 0, minute(60))]) == (1, [(1, 5)])
        # Line 7 belongs to an order of the first delivery.
        assert deliver(1, [(3, "x", 1, minute(90))], [(2, "x", 7, minute(65)), (3, "x", 9, minute(91))]) == (1, [(1, 5), (2, 7), (3, 9)])
        # Line 8 is late (before minute 40), and its order is gone.
        assert deliver(2, [(4, "x", 1, minute(92))], [(1, "x", 8, minute(5)), (4, "x", 2, minute(92))]) == (1, [(1, 5), (2, 7), (3, 9), (4, 2)])
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == kept == "true"


def test_running_totals_over_batches(spark, landed, tmp_path):  # STR-19
    out = aggregates.running_totals(chunks(spark, landed), F.col("region"), F.col("at"), F.col("amount"), ["id"], parts=3)
    io.drain(io.each_batch(out, io.batch_writer(str(tmp_path / "out")), "update"), str(tmp_path / "cp"))
    pieces = io.latest_state(spark.read.parquet(str(tmp_path / "out")), ["key", "part"])
    batch = spark.read.schema(SCHEMA).json(str(landed)).groupBy("region").agg(F.count("*"), F.sum("amount"), F.max("at"))
    assert rows(aggregates.merge_totals(pieces)) == rows(batch)


def test_running_totals_of_measured_keys(spark, landed, tmp_path):  # STR-19
    """Only keys measured to be hot are in several pieces; the totals are whole."""
    hot = spark.createDataFrame([("n", 4)], "region string, _parts int")
    out = aggregates.running_totals(chunks(spark, landed), F.col("region"), F.col("at"), F.col("amount"), ["id"], parts=1, hot=hot)
    io.drain(io.each_batch(out, io.batch_writer(str(tmp_path / "out")), "update"), str(tmp_path / "cp"))
    pieces = io.latest_state(spark.read.parquet(str(tmp_path / "out")), ["key", "part"])
    batch = spark.read.schema(SCHEMA).json(str(landed)).groupBy("region").agg(F.count("*"), F.sum("amount"), F.max("at"))
    assert rows(aggregates.merge_totals(pieces)) == rows(batch)
    several = pieces.groupBy("key").count().where("count > 1")
    assert rows(several, "key") == [("n",)]


def test_sessions(spark, tmp_path):  # STR-19
    land(tmp_path / "in", 0, [(1, "n", 1, minute(0)), (2, "n", 1, minute(4)), (3, "n", 1, minute(30)), (9, "z", 0, minute(600))])
    out = aggregates.sessions(chunks(spark, tmp_path / "in"), "at", "10 minutes", ["region"], [F.count("*").alias("n")], "1 minute")
    io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "region", "n") == [("n", 1), ("n", 2)]


def test_medallion_over_batches(spark, landed, tmp_path):  # STR-14, STR-15
    flow = Medallion(spark, str(tmp_path / "flow"))
    static = spark.createDataFrame([("n", "North"), ("s", "South")], "region string, label string")

    def run():
        flow.bronze(chunks(spark, landed))
        flow.silver(SCHEMA, "at", ["id"], {"amount": F.col("amount") > 5}, static, "region", {"double": F.col("amount") * 2}, "5 hours")
        silver = T.StructType([T.StructField("label", T.StringType()), T.StructField("double", T.LongType())])
        return rows(flow.gold(silver, ["label"], [F.count("*").alias("n"), F.sum("double").alias("total")]))

    assert run() == [("North", 5, 478), ("South", 2, 140)]
    assert rows(spark.read.parquet(flow.path("quarantine")), "id") == [(7,), (9,)]
    land(landed, 9, [(20, "s", 100, minute(95)), (1, "n", 10, minute(0))])
    assert run() == [("North", 5, 478), ("South", 3, 340)]


def test_upsert_stream_rewrites_few_buckets(spark, landed):  # STR-16
    table = workspace.fresh(spark, "up")
    base = spark.createDataFrame([("n", 0), ("w", 7)], "region string, amount long").unionByName(
        spark.range(200).select(F.concat(F.lit("r"), "id").alias("region"), F.col("id").alias("amount"))
    )
    buckets.create(base, table, ["region"], 16)
    files = lambda: {r[0] for r in spark.read.parquet(table).select("_metadata.file_path").distinct().collect()}
    before = files()
    stream = chunks(spark, landed).select("region", "amount", "at")
    upsert_stream(stream, table, ["region"], ["at"], workspace.fresh(spark, "cp"))
    got = buckets.read(spark, table).where("length(region) = 1")
    assert rows(got, "region", "amount") == [("n", 99), ("s", 5), ("w", 7)]
    done = buckets.steps(spark, table).where("state = 'done'")
    assert rows(done, "batch_id", "buckets") == [(0, 2), (1, 2), (2, 2), (3, 1), (4, 1)]
    # Files of the buckets without a key of the stream are the old ones.
    assert len(before) == 16 and len(before & files()) == 14


def test_upsert_stream_keeps_newer_rows(spark, landed):  # STR-16
    table = workspace.fresh(spark, "up")
    buckets.create(spark.createDataFrame([("n", 0, None), ("w", 7, None)], "region string, amount long, at timestamp"), table, ["region"], 4)
    stream = chunks(spark, landed).select("region", "amount", "at")
    upsert_stream(stream, table, ["region"], ["at"], workspace.fresh(spark, "cp"))
    assert rows(buckets.read(spark, table), "region", "amount") == [("n", 1), ("s", 5), ("w", 7)]


def test_broken_merges_are_finished(spark, monkeypatch):  # STR-16
    """A batch that fails before or after the replacement of its buckets counts once."""
    table = workspace.fresh(spark, "up")
    buckets.create(spark.createDataFrame([(i, i) for i in range(50)], "id long, v long"), table, ["id"], 8)
    replace, note = buckets._replace, buckets._note

    def fails(*args):
        raise OSError("lost")

    one, two = (spark.createDataFrame([(1, v), (100, v)], "id long, v long") for v in (-1, -2))
    monkeypatch.setattr(buckets, "_replace", fails)
    with pytest.raises(OSError):
        buckets.merge(spark, table, one, ["id"], ["v"], "f", 0)
    monkeypatch.setattr(buckets, "_replace", replace)
    # Another feed comes first: it completes the batch before its own.
    assert buckets.merge(spark, table, spark.createDataFrame([(2, 7)], "id long, v long"), ["id"], ["v"], "g", 0) == 1
    assert rows(buckets.read(spark, table).where("id IN (1, 2, 100)")) == [(1, 1), (100, -1), (2, 7)]
    assert buckets.merge(spark, table, one, ["id"], ["v"], "f", 0) == 0

    def fails_at_the_end(spark_, path, row):
        if row[2] == "done":
            raise OSError("lost")
        note(spark_, path, row)

    monkeypatch.setattr(buckets, "_note", fails_at_the_end)
    with pytest.raises(OSError):
        buckets.merge(spark, table, spark.createDataFrame([(1, 9)], "id long, v long"), ["id"], ["v"], "f", 1)
    monkeypatch.setattr(buckets, "_note", note)
    assert rows(buckets.read(spark, table).where("id IN (1, 2, 100)")) == [(1, 9), (100, -1), (2, 7)]
    assert buckets.read(spark, table).count() == 51


@pytest.mark.parametrize("policy, columns", [("none", ["a"]), ("rescue", ["a", "_rescued"]), ("addNewColumns", ["a", "b"])])
def test_new_column_policies(spark, policy, columns):  # STR-02
    batch = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": "x"}',)], "j string")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert io.check_columns(batch, "j", schema, policy).columns == columns
    with pytest.raises(ValueError):
        io.check_columns(batch, "j", schema, "failOnNewColumns")


def test_rate_sources(spark, tmp_path):  # STR-03, STR-05, STR-17
    query = io.run_continuously(io.to_files(io.rate_stream(spark, 50), str(tmp_path / "out")), str(tmp_path / "cp"), "1 second")
    try:
        assert str(query.id) in io.active_queries(spark)
        limit = time.time() + 60
        while time.time() < limit and not any(p.numInputRows for p in query.recentProgress):
            time.sleep(0.5)
    finally:
        query.stop()
    assert str(query.id) not in io.active_queries(spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    assert io.bounded_rate_stream(spark, 10).isStreaming


def test_continuous_trigger(spark, tmp_path):  # STR-05
    stream = io.rate_stream(spark, 40, partitions=2).filter("value % 2 = 0").select("value", (F.col("value") * 10).alias("ten"))
    query = io.run_without_batches(stream.writeStream.format("memory").queryName("continuous_rows"), str(tmp_path / "cp"), "1 second")
    try:
        limit = time.time() + 60
        while time.time() < limit and spark.table("continuous_rows").count() < 20:
            time.sleep(0.5)
        assert query.isActive and query.exception() is None
    finally:
        query.stop()
    got = [tuple(r) for r in spark.table("continuous_rows").collect()]
    assert len(got) >= 20 and all(v % 2 == 0 and t == 10 * v for v, t in got)
    with pytest.raises(Exception, match="(?i)continuous"):
        io.run_without_batches(stream.groupBy("ten").count().writeStream.format("memory").queryName("no_aggregates").outputMode("complete"), str(tmp_path / "cp2"), "1 second")


def test_illegal_output_modes(spark, landed, tmp_path):  # STR-04
    counts = chunks(spark, landed).groupBy("region").count()
    with pytest.raises(Exception, match="watermark"):
        io.drain(counts.writeStream.outputMode("append").format("memory").queryName("m1"), str(tmp_path / "c1"))
    with pytest.raises(Exception, match="(?i)complete"):
        io.drain(chunks(spark, landed).writeStream.outputMode("complete").format("memory").queryName("m2"), str(tmp_path / "c2"))


def test_session_timers_over_batches(spark, landed, tmp_path):  # STR-19
    """A late-coming event joins two open sessions; a session that ended leaves the state."""
    land(landed, 5, [(10, "n", 7, minute(200)), (11, "n", 3, minute(218)), (15, None, 4, minute(219))])
    land(landed, 6, [(12, "n", 2, minute(209))])
    land(landed, 7, [(13, "s", 1, minute(400))])
    land(landed, 8, [(14, "s", 1, minute(500))])
    out = timers.timed_sessions(chunks(spark, landed), ["region"], "at", F.col("amount"), 10 * 60, "20 minutes")
    query = io.drain(io.to_files(out, str(tmp_path / "out")), str(tmp_path / "cp"))
    got = rows(spark.read.parquet(str(tmp_path / "out")).fillna("none").select("region", F.date_format("session_start", "HH:mm").alias("a"), F.date_format("session_end", "HH:mm").alias("b"), "n", "cents"))
    assert got == [
        ("n", "10:00", "10:17", 4, 110), ("n", "10:40", "10:50", 1, 60), ("n", "11:30", "11:40", 1, 1), ("n", "13:20", "13:48", 3, 12),
        ("none", "13:39", "13:49", 1, 4),
        ("s", "10:01", "10:11", 1, 20), ("s", "10:11", "10:22", 2, 55), ("s", "16:40", "16:50", 1, 1),
    ]
    # Only the last session is still open.
    state = spark.read.format("statestore").option("stateVarName", "open").load(str(tmp_path / "cp"))
    assert state.select("key._key").distinct().collect() == [('{"region":"s"}',)]
    assert query.exception() is None


def test_session_timers_in_groups(spark, landed, tmp_path):  # STR-19
    """Keys that share their state have the sessions of keys apart, over several batches, and leave the same ones open."""
    for k in range(5, 9):
        land(landed, k, [(100 * k + i, "abcdefg"[i % 7] if i % 8 else None, i, minute(40 * k + 3 * i)) for i in range(25)])
    found = {}
    for groups in (None, 3):
        folder = tmp_path / f"groups{groups}"
        out = timers.timed_sessions(chunks(spark, landed), ["region"], "at", F.col("amount"), 10 * 60, "20 minutes", groups=groups)
        io.drain(io.to_files(out, str(folder / "out")), str(folder / "cp"))
        state = spark.read.format("statestore").option("stateVarName", "open").load(str(folder / "cp"))
        found[groups] = rows(spark.read.parquet(str(folder / "out"))), rows(state.select("list_element.*")), state.select("key._key").distinct().count()
    assert found[3][:2] == found[None][:2] and found[3][0]
    assert found[3][2] <= 3 < found[None][2]


def test_merged_spans():
    assert timers.merge_spans([(40, 41, 1, 1), (0, 5, 2, 2), (14, 21, 1, 4)], 10) == [(0, 21, 3, 6), (40, 41, 1, 1)]
    assert timers.merge_spans([(0, 5, 1, 1), (15, 16, 1, 1)], 10) == [(0, 5, 1, 1), (15, 16, 1, 1)]
    assert timers.merge_spans([(0, 5, 1, 1), (14, 16, 1, 1)], 10) == [(0, 16, 2, 2)]


def test_idle_keys_are_forgotten(spark, tmp_path):  # STR-19
    def drained(number, region, amount, forget):
        land(tmp_path / f"in{forget}", number, [(number, region, amount, minute(0))])
        out = timers.recent_totals(chunks(spark, tmp_path / f"in{forget}"), ["region"], F.col("amount"), forget)
        io.drain(io.each_batch(out, io.batch_writer(str(tmp_path / f"out{forget}")), "update"), str(tmp_path / f"cp{forget}"))
        return rows(spark.read.parquet(str(tmp_path / f"out{forget}")).filter(f"_batch_id = {number}"), "region", "n", "cents")

    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        assert drained(0, "n", 5, 3600) == [("n", 1, 5)]
        assert drained(1, "n", 6, 3600) == [("n", 2, 11)]
        assert drained(0, "n", 5, 1) == [("n", 1, 5)]
        time.sleep(2)
        assert drained(1, "n", 6, 1) == [("n", 1, 6)]
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_table_sink_appends_over_runs(spark, landed, tmp_path):  # STR-06
    name = "sink_" + tmp_path.name.replace("-", "_")
    for run in (0, 1):
        if run:
            land(landed, 7, [(20, "w", 1, minute(300))])
        io.drain_to_table(chunks(spark, landed), name, str(tmp_path / "cp"), str(tmp_path / "t"))
    assert rows(spark.table(name), "id")[-2:] == [(8,), (9,)] and spark.table(name).count() == sum(map(len, EVENTS)) + 1


def test_complete_mode_keeps_two_whole_results(spark, landed, tmp_path):  # STR-04
    out = chunks(spark, landed).groupBy("region").agg(F.sum("amount").alias("total"))
    path, seen = str(tmp_path / "out"), []
    write = io.whole_results(path)

    def watched(batch, batch_id):
        write(batch, batch_id)
        seen.append(rows(io.current_result(spark, path)))

    io.drain(io.each_batch(out, watched, "complete"), str(tmp_path / "cp"))
    assert seen == [[("n", 40), ("s", 20)], [("n", 110), ("s", 70)], [("n", 170), ("s", 75)], [("n", 171), ("s", 75)], [("n", 270), ("s", 75)]]
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["turn=0", "turn=1"]
