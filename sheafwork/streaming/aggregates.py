"""Windowed and stateful stream computations (STR-08..12, 18, 19)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(
    stream: DataFrame,
    at: str,
    length: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    late: str,
    slide: str | None = None,
) -> DataFrame:
    """STR-08..10: tumbling (or sliding) window aggregates with a watermark."""
    window = F.window(at, length, slide) if slide else F.window(at, length)
    return (
        stream.withWatermark(at, late)
        .groupBy(window.alias("w"), *keys)
        .agg(*aggregates)
        .select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
        .drop("w")
    )


def sessions(stream: DataFrame, at: str, gap: str, keys: Sequence[str], aggregates: Sequence[Column], late: str) -> DataFrame:
    """STR-19: sessions per key that end after ``gap`` without an event."""
    return (
        stream.withWatermark(at, late)
        .groupBy(F.session_window(at, gap).alias("w"), *keys)
        .agg(*aggregates)
        .select("*", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"))
        .drop("w")
    )


def unique_events(stream: DataFrame, at: str, keys: Sequence[str], late: str) -> DataFrame:
    """STR-12: first copy of every key; state older than the watermark is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def _with_parts(df: DataFrame, key: str, hot: DataFrame | None, parts: int) -> DataFrame:
    """Add ``_parts``, the number of tasks that share the rows of a key: that of a hot key, else ``parts``."""
    if hot is None:
        return df.withColumn("_parts", F.lit(parts))
    # At most rows / limit hot keys; as a staged table their size is known, and Spark decides on a broadcast.
    few = hot.select(F.col(hot.columns[0]).alias("_hot_key"), F.col("_parts").alias("_hot_parts"))
    found = df.join(few, F.col(key) == F.col("_hot_key"), "left")
    return found.withColumn("_parts", F.coalesce("_hot_parts", F.lit(parts))).drop("_hot_key", "_hot_parts")


def _spread(df: DataFrame, key: str, spread_by: Sequence[str], hot: DataFrame | None, parts: int, name: str) -> DataFrame:
    """One copy of each row, in one of the parts of its key."""
    return _with_parts(df, key, hot, parts).withColumn(name, F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")).drop("_parts")


def _copied(df: DataFrame, key: str, hot: DataFrame | None, parts: int, name: str) -> DataFrame:
    """One copy of each row for every part of its key."""
    return _with_parts(df, key, hot, parts).withColumn(name, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")


def enrich(
    stream: DataFrame, static: DataFrame, on: str, how: str = "left", spread_by: Sequence[str] = (), parts: int = 1,
    hot: DataFrame | None = None,
) -> DataFrame:
    """STR-11: stream-static join; Spark picks broadcast or shuffle by size.

    A stream plan cannot split a skewed shuffle at run time. ``hot`` names keys
    that were measured to hold much of the stream, with the parts they need
    (``skew.measured_hot``): stream rows of such a key go to several tasks by a
    hash of ``spread_by``, and only static rows of these keys are copied.
    ``parts`` > 1 does the same for all other keys, where nothing was measured.
    """
    if how not in ("left", "inner"):
        raise ValueError("the stream side must be the preserved side")
    if parts == 1 and hot is None:
        return stream.join(static, on, how)
    spread = _spread(stream, on, spread_by, hot, parts, "_part")
    return spread.join(_copied(static, on, hot, parts, "_part"), [on, "_part"], how).drop("_part")


def join_streams(
    left: DataFrame, right: DataFrame, left_at: str, right_at: str, match: Column, within: str, late: str,
    spread_by: Sequence[str] = (), parts: int = 1, hot: DataFrame | None = None, on: tuple[str, str] | None = None,
) -> DataFrame:
    """STR-18: inner join of two streams; the right event follows the left one within ``within``.

    ``hot`` names keys measured to hold much of the right stream, and ``on`` the
    key of each side: right rows of such a key are spread by a hash of
    ``spread_by``, and only left rows of these keys are kept once per part.
    ``parts`` > 1 does so for all other keys. The hot keys and their parts must
    stay the same as long as a checkpoint is used, since the state lies by part.
    """
    span = F.expr(f"INTERVAL {within}")
    timed = (F.col(right_at) >= F.col(left_at)) & (F.col(right_at) <= F.col(left_at) + span)
    if parts > 1 or hot is not None:
        if hot is not None and on is None:
            raise ValueError("hot keys need the key of each side")
        a, b = on or ("", "")
        left = _copied(left, a, hot, parts, "_left_part")
        right = _spread(right, b, spread_by, hot, parts, "_right_part")
        match = match & (F.col("_left_part") == F.col("_right_part"))
    joined = left.withWatermark(left_at, late).join(right.withWatermark(right_at, late), match & timed, "inner")
    return joined.drop("_left_part", "_right_part")


_OUTPUT = "key string, part int, n_events bigint, total_cents bigint, last_at timestamp"
_STATE = "n_events bigint, total_cents bigint, last_at timestamp"


def _add_events(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    n, cents, last = state.get if state.exists else (0, 0, None)
    for pdf in frames:
        n += len(pdf)
        cents += int(pdf["cents"].sum())
        newest = pdf["at"].max()
        last = newest if last is None else max(pd.Timestamp(last), newest)
    state.update((n, cents, last))
    yield pd.DataFrame(
        {"key": [key[0]], "part": [key[1]], "n_events": [n], "total_cents": [cents], "last_at": [last]}
    )


def running_totals(
    stream: DataFrame, key: Column, at: Column, cents: Column, spread_by: Sequence[str], parts: int = 4, hot: DataFrame | None = None
) -> DataFrame:
    """STR-19: totals per key in custom state, kept in ``parts`` pieces.

    The state of one key is divided by a hash of ``spread_by``, so a key that
    receives most of the stream still uses several tasks. ``merge_totals`` adds
    the pieces up. Every piece costs a call into Python: with keys measured to
    be ``hot`` (``skew.measured_hot``) these have their own number of pieces, and
    ``parts`` = 1 leaves one for each other key.
    """
    if hot is not None:
        hot = hot.withColumn(hot.columns[0], F.col(hot.columns[0]).cast("string"))
    spread = _spread(stream.withColumn("_total_key", key.cast("string")), "_total_key", spread_by, hot, parts, "_piece")
    rows = spread.select(
        F.col("_total_key").alias("key"),
        F.col("_piece").alias("part"),
        at.cast("timestamp").alias("at"),
        cents.cast("bigint").alias("cents"),
    )
    return rows.groupBy("key", "part").applyInPandasWithState(
        _add_events, _OUTPUT, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def merge_totals(state: DataFrame) -> DataFrame:
    return state.groupBy("key").agg(
        F.sum("n_events").alias("n_events"),
        F.sum("total_cents").alias("total_cents"),
        F.max("last_at").alias("last_at"),
    )
