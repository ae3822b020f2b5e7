"""Upserts into plain Parquet partitioned by a bucket of the key (VER-03, STR-16).

A batch reads and rewrites only the buckets that its keys fall into, by dynamic
partition overwrite; all other folders stay as they are. The merged rows are
staged before they replace anything, and a small table of steps says what was
staged and what is done. So a batch that broke off anywhere is finished by the
next call, whoever makes it, and a batch that runs again is known by its feed
and number. One writer at a time.

Beside the rows lies a digest of every bucket: the number of its rows and the
sums of two 64-bit hashes of each row, in no order. It is renewed with the bucket. Two states of a
table are compared by their digests first, so that ``changes`` (VER-09) reads
and joins only the buckets that differ.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork import workspace
from sheafwork.operators.dedup import keep_one
from sheafwork.operators.versions import change_feed, upsert

_BUCKET = "_bucket"
_STEPS = "feed string, batch_id bigint, state string, staged string, buckets bigint"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _shape(value: Column, kind: T.DataType) -> Column:
    """What the hash of a value leaves out: which parts are null, and how long arrays are."""
    if isinstance(kind, T.ArrayType):
        return F.struct(value.isNull(), F.size(value), F.transform(value, lambda x: _shape(x, kind.elementType)))
    if isinstance(kind, T.StructType):
        return F.struct(value.isNull(), *[_shape(value[f.name], f.dataType) for f in kind.fields])
    return value.isNull()


def digests(placed: DataFrame) -> DataFrame:
    """Digest of each bucket of ``placed``, in any order of its rows; map columns have none.

    The hash is fast, not cryptographic: two states that differ are told apart
    but for a chance of about 2^-128.
    """
    parts = [x for f in placed.schema.fields if f.name != _BUCKET for x in (F.col(f"`{f.name}`"), _shape(F.col(f"`{f.name}`"), f.dataType))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")).alias(f"hash_{seed}") for seed in (1, 2)]
    return placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def _digests_path(path: str) -> str:
    return f"{path.rstrip('/')}_digests"


def _keep_digests(placed: DataFrame, path: str) -> None:
    """Renew the digests of the buckets in ``placed``; doing so again changes nothing."""
    renewed = digests(placed).repartition(_BUCKET)
    renewed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(_digests_path(path))


def _kept_digests(spark: SparkSession, path: str) -> DataFrame:
    schema = f"n_rows bigint, hash_1 decimal(30,0), hash_2 decimal(30,0), {_BUCKET} int"
    return spark.read.schema(schema).parquet(_digests_path(path))


def differing(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose digests differ between two tables; at most as many numbers as there are buckets."""
    a, b = ({r[_BUCKET]: tuple(r) for r in _kept_digests(spark, path).collect()} for path in (old, new))
    return sorted(k for k in a.keys() | b.keys() if a.get(k) != b.get(k))


def changes(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """VER-09: the change feed from table ``old`` to table ``new``; buckets of equal digests stay unread.

    Both tables have the same columns, keys and number of buckets.
    """
    for path in (old, new):
        finish(spark, path)
    if _created(spark, old).buckets != _created(spark, new).buckets:
        raise ValueError("the tables differ in their number of buckets")
    touched = differing(spark, old, new)
    before, after = (_stored(spark, path).where(F.col(_BUCKET).isin(touched)) for path in (old, new))
    return change_feed(before, after, [*keys, _BUCKET]).drop(_BUCKET)


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` as the first state, one folder and one file for each bucket."""
    placed = df.withColumn(_BUCKET, bucket_of(keys, buckets))
    placed.repartition(_BUCKET).write.mode("errorifexists").partitionBy(_BUCKET).parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    _keep_digests(stored, path)
    # The first step keeps the schema: a table may have no rows yet.
    _note(df.sparkSession, path, ("", -1, "created", placed.schema.json(), buckets))


def ensure(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> None:
    """Create the table without rows unless it is there."""
    try:
        _created(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        create(spark.createDataFrame([], schema), path, keys, buckets)


def _steps_path(path: str) -> str:
    return f"{path.rstrip('/')}_steps"


def steps(spark: SparkSession, path: str) -> DataFrame:
    """One row for each step of each batch: ``staged``, then ``done``, with the number of buckets it rewrites."""
    return spark.read.schema(_STEPS).parquet(_steps_path(path))


def _created(spark: SparkSession, path: str):
    return steps(spark, path).where("state = 'created'").first()


def _stored(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(_created(spark, path).staged))
    return spark.read.schema(schema).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    finish(spark, path)
    return _stored(spark, path).drop(_BUCKET)


def _note(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], _STEPS).coalesce(1).write.mode("append").parquet(_steps_path(path))


def _replace(spark: SparkSession, path: str, staged: str) -> None:
    """Put staged buckets in the place of the old ones; doing so again changes nothing."""
    rows = spark.read.parquet(staged)
    rows.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    _keep_digests(rows, path)


def finish(spark: SparkSession, path: str) -> None:
    """Complete the batch, if any, that broke off between its staging and its end."""
    by_batch = steps(spark, path).groupBy("feed", "batch_id").agg(
        F.max(F.when(F.col("state") == "staged", F.struct("staged", "buckets"))).alias("s"), F.max(F.col("state") == "done").alias("done")
    )
    # With one writer no more than one batch is open.
    for r in by_batch.where("NOT done AND s IS NOT NULL").collect():
        _replace(spark, path, r.s.staged)
        _note(spark, path, (r.feed, r.batch_id, "done", r.s.staged, r.s.buckets))


def merge(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], newest: Sequence[str], feed: str = "batch", batch_id: int = 0
) -> int:
    """Upsert ``rows``; returns how many buckets were rewritten.

    ``newest`` names the columns that order the rows of a key: within a batch the
    newest row counts, and where the table has these columns too, a row older
    than the one held is left out; without names every row replaces the one held.
    A batch whose feed and number are done is
    skipped.
    """
    finish(spark, path)
    known = steps(spark, path)
    if not known.where((F.col("feed") == feed) & (F.col("batch_id") == batch_id) & (F.col("state") == "done")).isEmpty():
        return 0
    buckets = _created(spark, path).buckets
    placed = keep_one(rows, keys, [F.col(c) for c in newest]).withColumn(_BUCKET, bucket_of(keys, buckets))
    placed = workspace.stage(placed, "merge_rows")
    # At most as many numbers as there are buckets.
    touched = [r[0] for r in placed.select(_BUCKET).distinct().collect()]
    if not touched:
        return 0
    target = _stored(spark, path).where(F.col(_BUCKET).isin(touched))
    fresh = placed
    if newest and set(newest) <= set(target.columns):
        held = target.select(*keys, F.struct(*newest).alias("_held"))
        current = F.col("_held").isNull() | (F.struct(*newest) >= F.col("_held"))
        fresh = placed.join(held, list(keys), "left").where(current).drop("_held")
    staged = workspace.fresh(spark, "merged")
    # The bucket follows from the key, so it is a column like any other; it is the same on both sides.
    upsert(target, fresh, keys).write.parquet(staged)
    step = (feed, batch_id, "staged", staged, len(touched))
    _note(spark, path, step)
    _replace(spark, path, staged)
    _note(spark, path, (*step[:2], "done", *step[3:]))
    return len(touched)
