"""Keeping one hot key from filling one task.

A key may hold a large part of all rows. The helpers here find such keys with a
map-side-combined count and split only those; all other keys take the ordinary
path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork import workspace

ROWS_PER_TASK = 1_000_000
BROADCAST_KEYS = 100_000


#: Smallest share of the rows that Spark's frequency sketch accepts.
LEAST_SUPPORT = 1e-4


def frequent_candidates(df: DataFrame, keys: Sequence[str], support: float) -> DataFrame:
    """QLT-07: all keys with at least ``support`` of the rows, and perhaps some others; at most 1 / support rows.

    A Misra-Gries sketch of that many counters is filled in each task and merged:
    one pass, and no row of a key is shuffled.
    """
    found = df.select(F.struct(*keys).alias("_key")).stat.freqItems(["_key"], support)
    return found.select(F.explode("_key_freqItems").alias("_key")).select("_key.*")


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``limit`` rows and the number of parts they need.

    There are at most rows / limit such keys, whatever the data looks like. A
    sketch names the candidates and a second pass counts them exactly; all other
    keys are neither shuffled nor counted. A limit below ``LEAST_SUPPORT`` of the
    rows is too fine for the sketch: then all keys are counted, combined on the
    map side, so that a key leaves one row for each task.
    """
    total = df.count()
    rows = df
    if limit < total and limit / total >= LEAST_SUPPORT:
        candidates = frequent_candidates(df, keys, limit / total)
        names = [f"_hot_{k}" for k in keys]
        # At most total / limit rows, so no more than 1 / LEAST_SUPPORT; Spark broadcasts them where they are few.
        stored = workspace.stage(candidates.withColumnsRenamed(dict(zip(keys, names))), "frequent")
        rows = df.join(stored, _match(keys, names), "left_semi")
    elif limit >= total:
        rows = df.limit(0)
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > limit)
        .select(*keys, F.ceil(F.col("_rows") / F.lit(limit)).cast("int").alias("_parts"))
    )


def _measured(hot: DataFrame) -> tuple[DataFrame, int]:
    """Store the hot keys and count them, so that plans can depend on the number."""
    stored = workspace.stage(hot, "hot_keys")
    return stored, stored.count()


def measured_hot(df: DataFrame, keys: Sequence[str], limit: int = ROWS_PER_TASK) -> DataFrame | None:
    """The hot keys of ``df`` with their parts as a stored table; None if there are none."""
    stored, n = _measured(hot_keys(df, keys, limit))
    return stored if n else None


def _match(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def _with_parts(df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], hot: DataFrame, n_hot: int) -> DataFrame:
    if n_hot == 0:
        return df.withColumn("_part", F.lit(0))
    names = [f"_hot_{k}" for k in keys]
    small = hot.withColumnsRenamed(dict(zip(keys, names)))
    if n_hot <= BROADCAST_KEYS:
        small = F.broadcast(small)
    part = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("_parts"), F.lit(1))).cast("int")
    return df.join(small, _match(keys, names), "left").withColumn("_part", part).drop("_parts", *names)


def split_hot(
    df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], limit: int = ROWS_PER_TASK
) -> DataFrame:
    """Add ``_part``: 0 for an ordinary key, a hash of ``spread_by`` for a hot one.

    Grouping by keys + ``_part`` then puts about ``limit`` rows in a group. The
    hot keys are counted first: none means no join at all, few are broadcast,
    and beyond ``BROADCAST_KEYS`` an ordinary join is used.
    """
    return _with_parts(df, keys, spread_by, *_measured(hot_keys(df, keys, limit)))


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    partial: Sequence[Column],
    final: Sequence[Column],
    salts: int = 16,
) -> DataFrame:
    """AGG-21: aggregate by key and salt, then by key.

    The salt is its own column, so key values never have to be taken apart.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    return salted.groupBy(*keys, "_salt").agg(*partial).groupBy(*keys).agg(*final)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """JON-16: equi-join that spreads hot fact keys over several tasks.

    Only rows of ``dim`` whose key is hot are copied, once per part; every other
    dimension row is sent once. ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot, n_hot = _measured(hot_keys(fact.select(key), [key], limit))
    if n_hot == 0:
        return fact.join(dim, key, how)
    left = _with_parts(fact, [key], spread_by, hot, n_hot)
    parts = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    right = (
        dim.join(parts, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    return left.join(right, [key, "_part"], how).drop("_part")
