"""Sources, sinks, versioned tables, layout and quality jobs."""

from __future__ import annotations

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators import buckets, joins, quality, versions
from sheafwork.plans import bronze
from sheafwork.plans.run import Step, run_steps
from sheafwork.sinks import layers, layout
from sheafwork.sources import cube, files, landing
from tests.conftest import rows


def cube_text(values, order=("id", "size", "value", "dimension")):
    doc = {
        "id": ["geo", "time"], "size": [2, 3], "value": values,
        "dimension": {
            "geo": {"category": {"index": {"AT": 0, "RO": 1}}},
            "time": {"category": {"index": {"2022": 2, "2020": 0, "2021": 1}}},
        },
    }
    return json.dumps({k: doc[k] for k in order})


def test_cube_decode(spark, tmp_path):  # SRC-10
    (tmp_path / "a.json").write_text(cube_text({"0": 1, "2": None, "4": 5.5}))
    got = cube.decode(cube.read_cubes(spark, str(tmp_path)), ["geo", "time"])
    assert rows(got, "geo", "time", "value") == [("AT", "2020", 1.0), ("RO", "2021", 5.5)]


def test_one_large_cube_decodes_in_many_tasks(spark, tmp_path):  # SRC-10
    n_geo, n_time = 1000, 1000
    text = json.dumps({
        "id": ["geo", "time"], "size": [n_geo, n_time], "value": {str(i): i * 0.5 for i in range(n_geo * n_time)},
        "dimension": {
            "geo": {"category": {"index": {f"g{i}": i for i in range(n_geo)}}},
            "time": {"category": {"index": {f"t{i}": i for i in range(n_time)}}},
        },
    })
    (tmp_path / "big.json").write_text(text)
    got = cube.decode(cube.read_cubes(spark, str(tmp_path)), ["geo", "time"]).withColumn("task", F.spark_partition_id())
    cell = F.substring("geo", 2, 9).cast("int") * n_time + F.substring("time", 2, 9).cast("int")
    right = F.sum((F.col("value") == cell * 0.5).cast("int"))
    per_task = [tuple(r) for r in got.groupBy("task").agg(F.count("*"), right).collect()]
    assert sum(n for _, n, _ in per_task) == sum(ok for *_, ok in per_task) == n_geo * n_time
    assert len(per_task) >= 4 and max(n for _, n, _ in per_task) <= n_geo * n_time // 2


def test_cube_parts_of_few_cells(spark, tmp_path):
    """Parts that do not divide the cells, a document without cells, and more labels than cells of a part."""
    (tmp_path / "a.json").write_text(cube_text({"0": 1, "1": 2, "2": None, "4": 5.5, "5": 0}))
    (tmp_path / "b.json").write_text(cube_text({}))
    docs = cube.read_cubes(spark, str(tmp_path))
    whole = rows(cube.decode(docs, ["geo", "time"]))
    assert len(whole) == 4 and rows(cube.decode(docs, ["geo", "time"], part_cells=1)) == whole


def test_cube_round_trip(spark, tmp_path):
    panel = spark.createDataFrame([("x", "2020", 1.0), ("y", "2021", 2.0), ("y", "2020", 3.0)], "geo string, time string, value double")
    docs = cube.encode(panel, ["geo", "time"], "value", F.lit("p"))
    (tmp_path / "a.json").write_text(docs.first()["document"])
    got = cube.decode(cube.read_cubes(spark, str(tmp_path)), ["geo", "time"])
    assert rows(got, "geo", "time", "value") == rows(panel)


def test_bronze_cubes_incremental(spark, tmp_path):  # PIP-01, SRC-11, SRC-12
    land, target = tmp_path / "land", str(tmp_path / "bronze")
    land.mkdir()
    (land / "a.json").write_text(cube_text({"0": 1}))
    # Same content with another key order: not new.
    (land / "b.json").write_text(cube_text({"0": 1}, ("dimension", "value", "size", "id")))
    layers.append_rows(bronze.load_cubes(spark, str(land), ["geo", "time"], "feed", None), target)
    assert spark.read.parquet(target).count() == 1
    (land / "c.json").write_text(cube_text({"1": 2, "3": 4}))
    loaded = spark.read.parquet(target)
    # Landed again under a new name, and a document cut short.
    (land / "d.json").write_text(cube_text({"0": 1}))
    (land / "e.json").write_text(cube_text({"5": 1})[:-20])
    again = bronze.load_cubes(spark, str(land), ["geo", "time"], "feed", loaded)
    assert rows(again, "geo", "time", "value") == [("AT", "2021", 2.0), ("RO", "2020", 4.0)]
    layers.append_rows(again, target)
    assert bronze.load_cubes(spark, str(land), ["geo", "time"], "feed", spark.read.parquet(target)).isEmpty()
    (dead,) = bronze.broken_cubes(spark, str(land)).collect()
    assert dead.source_file.endswith("e.json") and dead.document == cube_text({"5": 1})[:-20]


def test_bronze_stream_opens_new_files_only(spark, tmp_path):  # PIP-01, SRC-11, SRC-12
    land, target = tmp_path / "land", str(tmp_path / "bronze")
    land.mkdir()

    def load():
        log = bronze.ingest_cubes(spark, str(land), ["geo", "time"], "feed", target, str(tmp_path / "cp"))
        return log.agg(F.sum("input_rows")).first()[0]

    (land / "a.json").write_text(cube_text({"0": 1}))
    (land / "b.json").write_text(cube_text({"0": 1}, ("dimension", "value", "size", "id")))
    assert load() == 2 and spark.read.parquet(target).count() == 1
    (land / "c.json").write_text(cube_text({"1": 2, "3": 4}))
    (land / "d.json").write_text(cube_text({"0": 1}))
    (land / "e.json").write_text(cube_text({"5": 1})[:-20])
    assert load() == 3 and not load()
    stored = spark.read.parquet(target)
    assert rows(stored, "geo", "time", "value") == [("AT", "2020", 1.0), ("AT", "2021", 2.0), ("RO", "2020", 4.0)]
    (dead,) = spark.read.parquet(f"{target}_broken").collect()
    assert dead.source_file.endswith("e.json") and dead.document == cube_text({"5": 1})[:-20]
    # Another checkpoint sees all files again, and no new content.
    again = bronze.ingest_cubes(spark, str(land), ["geo", "time"], "feed", target, str(tmp_path / "cp2"), max_files_per_trigger=2)
    assert rows(again, "input_rows") == [(1,), (2,), (2,)] and spark.read.parquet(target).count() == 3


def test_content_hashes(spark, tmp_path):  # SRC-12
    for name, text in (("a.json", cube_text({"0": 1})), ("b.json", cube_text({"0": 1}, ("value", "id", "size", "dimension")))):
        (tmp_path / name).write_text(text)
    raw = landing.content_hashes(spark, str(tmp_path))
    canonical = landing.canonical_cube_hash(cube.read_cubes(spark, str(tmp_path)))
    assert raw.select("content_hash").distinct().count() == 2
    assert canonical.select("content_hash").distinct().count() == 1


def test_csv_load_and_listing(spark, tmp_path):  # SRC-01, SRC-13, SRC-14
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("k,v\na,1\nb,x\n")
    rows_ = files.read_csv_checked(spark, str(land), "k string, v int")
    kept = workspace.stage(rows_, "csv")
    assert rows(kept.filter(F.col(files.CORRUPT).isNotNull()), "k", files.CORRUPT) == [("b", "b,x")]
    assert files.infer_csv(spark, str(land)).columns == ["k", "v"]
    listed = landing.list_files(spark, str(land), "*.csv")
    assert landing.recent_files(listed).count() == 1
    assert landing.newest_per_group(listed, landing.folder_of(F.col("path"))).count() == 1


def test_generated_and_local_rows(spark):  # SRC-06, SRC-07
    assert rows(files.number_range(spark, 3)) == [(0,), (1,), (2,)]
    assert spark.createDataFrame([(1, "a")], "id int, s string").schema.simpleString() == "struct<id:int,s:string>"


def test_tables_and_catalog(spark):  # SNK-01, SNK-02, SNK-08, SNK-09, SNK-13
    layers.ensure_schema(spark, "layer_a", "first layer")
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    layers.append_table(df, "layer_a.t")
    layers.append_table(df, "layer_a.t")
    assert spark.table("layer_a.t").count() == 2
    layers.rewrite_table(df.withColumn("n", F.lit(1)), "layer_a.t")
    assert layers.catalog_columns(spark, "layer_a.t") == [("id", "int"), ("s", "string"), ("n", "int")]
    made = layers.create_from_query(spark, "layer_a.u", df)
    layers.insert_rows(spark, "layer_a.u", df)
    assert made.count() == 2
    layers.insert_rows(spark, "layer_a.u", df, overwrite=True)
    spark.catalog.refreshTable("layer_a.u")
    assert spark.table("layer_a.u").count() == 1
    assert layers.catalog_tables(spark, "layer_a") == ["t", "u"]


def test_views(spark):  # SNK-12
    df = spark.range(2)
    layers.publish_view(df, "some_view")
    assert spark.catalog.tableExists("some_view")
    assert layers.drop_view(spark, "some_view") and not spark.catalog.tableExists("some_view")
    name = layers.publish_view(df, "shared_view", everywhere=True)
    assert spark.newSession().table(name).count() == 2


def test_partition_overwrite_keeps_others(spark, tmp_path):  # SNK-07
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    layers.write_partitioned(df, path, ["k"])
    layers.write_partitioned(spark.createDataFrame([(9, "a")], "v int, k string"), path, ["k"])
    assert rows(spark.read.parquet(path), "v", "k") == [(2, "b"), (9, "a")]


def test_export_is_one_file(spark, tmp_path):  # SNK-03
    layers.export_single_file(spark.range(1000, numPartitions=7), str(tmp_path / "y"), "csv")
    (part,) = (tmp_path / "y").glob("part-*.csv")
    assert len(part.read_text().splitlines()) == 1001


def test_lookup_checks_bytes(spark):  # JON-10
    fact = spark.range(3)
    wide = fact.withColumn("text", F.repeat(F.lit("x"), F.lit(20 << 20)))
    for dim, hinted in ((fact, True), (wide, False)):
        plan = joins.lookup_join(fact, dim, "id")._jdf.queryExecution().analyzed().toString()
        assert ("ResolvedHint (strategy=broadcast)" in plan) == hinted


def test_shared_is_released(spark):  # SNK-11
    df = spark.range(5)
    with layers.shared(df) as kept:
        assert kept.count() == 5 and kept.is_cached
    assert not kept.is_cached


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id int, s string, n int")


def test_update_and_delete_null_condition(target):  # VER-01, VER-02
    changed = versions.update_where(target, F.col("s") == "a", {"n": F.lit(0)})
    assert rows(changed, "id", "n") == [(1, 0), (2, 20), (3, 30)]
    assert rows(versions.delete_where(target, F.col("s") == "a"), "id") == [(2,), (3,)]


def test_upsert(spark, target):  # VER-03, VER-04
    source = spark.createDataFrame([(2, "B", 21), (99, "new", 1)], "id int, s string, n int")
    assert rows(versions.upsert(target, source, ["id"])) == [(1, "a", 10), (2, "B", 21), (3, None, 30), (99, "new", 1)]
    part = versions.upsert(target, source, ["id"], update=["n"], insert=["s"])
    assert rows(part) == [(1, "a", 10), (2, "b", 21), (3, None, 30), (99, "new", None)]
    with pytest.raises(ValueError):
        versions.upsert(target, source.union(source), ["id"])


def test_upsert_source_null_wins(spark, target):
    source = spark.createDataFrame([(1, None, 11)], "id int, s string, n int")
    assert (1, None, 11) in rows(versions.upsert(target, source, ["id"]))


def test_changes_read_only_differing_buckets(spark):  # VER-09
    base = spark.createDataFrame([(i, f"s{i}", [i, None]) for i in range(200)], "id long, s string, a array<long>")
    old, new = workspace.fresh(spark, "old"), workspace.fresh(spark, "new")
    for path in (old, new):
        buckets.create(base.repartition(3), path, ["id"], 16)
    assert buckets.differing(spark, old, new) == [] and buckets.changes(spark, old, new, ["id"]).isEmpty()
    # A null that changed its place within an array, and a new key.
    buckets.merge(spark, new, spark.createDataFrame([(5, "s5", [None, 5]), (500, None, None)], base.schema), ["id"], [])
    touched = buckets.differing(spark, old, new)
    assert 1 <= len(touched) <= 2
    # Files of equal buckets are broken on purpose: whoever reads them fails.
    for path in (old, new):
        for folder in pathlib.Path(path).glob("_bucket=*"):
            if int(folder.name.split("=")[1]) not in touched:
                for part in folder.glob("*.parquet"):
                    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
                    part.write_bytes(b"not a table")
    got = rows(buckets.changes(spark, old, new, ["id"]), "id", "change_type", "a")
    assert got == [(5, "update_postimage", [None, 5]), (5, "update_preimage", [5, None]), (500, "insert", None)]


def test_digest_tells_shapes_apart(spark):  # VER-09
    def digest(values, kind):
        return buckets.digests(spark.createDataFrame([(1, *v) for v in values], f"_bucket int, {kind}")).first()

    pairs = [("a string, b string", ("x", None), (None, "x")), ("a array<array<int>>, b int", ([[1], [2]], 0), ([[1, 2]], 0)),
             ("a array<int>, b int", ([], 1), (None, 1)), ("a struct<x:int,y:int>, b int", ((1, None), 1), ((None, 1), 1))]
    for kind, one, two in pairs:
        assert digest([one], kind) != digest([two], kind)
        assert digest([one, two], kind) == digest([two, one], kind) != digest([one, one], kind)


def test_change_feed(spark, target):  # VER-09
    new = spark.createDataFrame([(1, "a", 10), (2, "b", 25), (4, "d", 40)], "id int, s string, n int")
    got = rows(versions.change_feed(target, new, ["id"]), "id", "change_type", "n")
    assert got == [(2, "update_postimage", 25), (2, "update_preimage", 20), (3, "delete", 30), (4, "insert", 40)]


def test_versions(spark, target):  # VER-05..08, VER-13
    t = versions.VersionedTable(spark, workspace.fresh(spark, "vt"))
    day = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in range(1, 9)]
    t.create(target, day[0])
    t.append(target.filter("id = 1"), day[1])
    t.commit(versions.delete_where(t.read(), F.col("id") == 1), "DELETE", day[2])
    assert [t.read(v).count() for v in (0, 1, 2)] == [3, 4, 2]
    assert t.read_at(day[1] + dt.timedelta(hours=1)).count() == 4
    with pytest.raises(ValueError):
        t.read_at(dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc))
    t.restore(0, day[3])
    assert t.read().count() == 3 and t.latest() == 3
    assert rows(t.expired(day[4], 48), "version") == [(0,), (1,)]
    with pytest.raises(ValueError):
        t.append(target.withColumn("extra", F.lit(1)))
    # What a commit that failed before its history row leaves behind.
    target.write.parquet(f"{t.path}/v=4")
    assert t.commit(target.filter("id = 2"), "DELETE") == 4 and t.read().count() == 1


def test_schema_rules(spark, target):  # VER-10
    wider = target.withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        versions.evolve(target, wider)
    assert versions.evolve(target, wider, True).columns[-1] == "extra"
    with pytest.raises(ValueError, match="type"):
        versions.evolve(target, target.withColumn("n", F.lit("x")), True)


def test_z_order_skips_more_files(spark):  # VER-12
    df = spark.range(20000).select((F.hash("id") % 1000).alias("a"), (F.hash(F.col("id") + 7) % 1000).alias("b"))
    clustered, plain = workspace.fresh(spark, "z"), workspace.fresh(spark, "plain")
    layout.z_order(df, ["a", "b"], clustered, 16)
    layout.compact_to(df, plain, 16)

    def touched(path):
        ranges = layout.file_ranges(spark.read.parquet(path), ["a", "b"])
        return ranges.filter("min_a <= 100 AND max_a >= 100").count() + ranges.filter("min_b <= 100 AND max_b >= 100").count()

    assert touched(clustered) < touched(plain) / 2
    assert rows(spark.read.parquet(clustered)) == rows(df)


def test_z_order_over_text_and_dates(spark):  # VER-12
    df = spark.range(12000).select(
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("c"), F.hash("id") % 40)).alias("country"),
        F.date_add(F.lit("2020-01-01"), F.pmod(F.hash(F.col("id") + 7), F.lit(700))).alias("day"),
        F.col("id").cast("decimal(12,2)").alias("n"),
    )
    edges = layout.bucket_edges(df, ["country", "day", "n"], 8, sample_rows=2000)
    assert all(e == sorted(set(e)) and 6 <= len(e) <= 7 for e in edges)
    clustered, plain = workspace.fresh(spark, "z"), workspace.fresh(spark, "plain")
    layout.z_order(df, ["country", "day"], clustered, 16)
    layout.compact_to(df, plain, 16)

    def touched(path):
        ranges = layout.file_ranges(spark.read.parquet(path), ["country", "day"])
        return ranges.filter("min_country <= 'c12' AND max_country >= 'c12'").count() + ranges.filter("min_day <= '2020-06-01' AND max_day >= '2020-06-01'").count()

    assert touched(clustered) < touched(plain) * 0.6
    assert rows(spark.read.parquet(clustered)) == rows(df)
    layout.z_order(df.limit(0), ["country", "day"], workspace.fresh(spark, "z"), 2)


def test_compaction(spark):  # VER-11, VER-14
    many, few = workspace.fresh(spark, "many"), workspace.fresh(spark, "few")
    spark.range(1000).repartition(20).write.parquet(many)
    layout.compact(spark.read.parquet(many), few)
    n = [layout.file_report(spark, p).first().n_files for p in (many, few)]
    assert n[0] == 20 and n[1] < 20


def test_quality(spark, target):  # QLT-01..04, QLT-06, QLT-07, QLT-09
    log = quality.quality_log(target.withColumn("source_file", F.lit(None).cast("string")), "t", "f").first()
    assert (log.total_rows, log.null_summary) == (3, '{"s":1}') and log.logged_at is not None
    assert quality.quality_log(target.select("id"), "t", "f").first().null_summary == "{}"
    with pytest.raises(ValueError):
        quality.require_rows(target.filter("id > 9"), "t")
    rules = {"has_s": F.col("s").isNotNull(), "big": F.col("n") > 15}
    ok, bad = quality.split_rows(target, rules)
    assert rows(ok, "id") == [(2,)]
    assert {r.id: r.reasons for r in bad.collect()} == {1: ["big"], 3: ["has_s"]}
    with pytest.raises(ValueError):
        quality.require_valid(target, rules, "t")
    amounts = spark.createDataFrame([(99.99,), (None,), (-5.0,), (150.0,), (None,), (0.0,)], "a double")
    flagged = amounts.select(quality.status_of(F.col("a")).alias("s"))
    assert rows(flagged.groupBy("s").count()) == [("INVALID", 2), ("NULL", 2), ("OK", 2)]
    watched, seen = quality.counted(amounts, "amounts", {"nulls": F.col("a").isNull()})
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 6, "nulls": 2}
    assert {r.s: r.share for r in quality.key_skew(flagged, ["s"]).collect()}["OK"] == pytest.approx(1 / 3)
    hidden = quality.masked(target, {"s": F.lit("*")}, F.col("id") == 1, F.col("id") < 3)
    assert rows(hidden, "id", "s") == [(1, "a"), (2, "*")]


def test_run_stops_at_failure(spark):  # PIP-27
    def fail():
        raise RuntimeError("broken")

    steps = [Step("a", lambda: 1), Step("b", fail, ["a"]), Step("c", lambda: 2, ["a"])]
    got = [(r.step, r.status, r.n_rows) for r in run_steps(spark, steps).orderBy("position").collect()]
    assert got == [("a", "done", 1), ("b", "failed", None), ("c", "skipped", None)]
    with pytest.raises(ValueError):
        run_steps(spark, [Step("b", fail, ["a"])])
