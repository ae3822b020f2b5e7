"""Chained bronze, silver and gold streams and stream upserts (STR-13..16)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork.operators import buckets
from sheafwork.operators.quality import split_rows
from sheafwork.operators.skew import ROWS_PER_TASK, measured_hot
from sheafwork.streaming import io
from sheafwork.streaming.aggregates import enrich, unique_events


@dataclass(frozen=True)
class Medallion:
    """Three checkpointed queries over folders below ``root``."""

    spark: SparkSession
    root: str

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def _checkpoint(self, layer: str) -> str:
        return f"{self.root}/_checkpoints/{layer}"

    def bronze(self, raw: DataFrame) -> None:
        """STR-13: raw rows as they come, under the id of their batch."""
        io.drain(io.each_batch(raw, io.batch_writer(self.path("bronze"))), self._checkpoint("bronze"))

    def silver(
        self,
        schema: T.StructType,
        at: str,
        key: Sequence[str],
        rules: Mapping[str, Column],
        static: DataFrame,
        on: str,
        derived: Mapping[str, Column],
        late: str,
        hot_rows: int = ROWS_PER_TASK,
    ) -> None:
        """STR-11/12/14: valid, unique and enriched rows; rejected ones go to ``quarantine`` with their reasons.

        The duplicate check keeps state across batches; a check inside each
        batch would let a copy in a later batch through. Static keys with more
        than ``hot_rows`` rows in the bronze layer are spread over tasks.
        """
        stored = T.StructType([*schema.fields, T.StructField("_feed", T.StringType()), T.StructField("_batch_id", T.LongType())])
        stream = io.event_time(io.file_stream(self.spark, self.path("bronze"), stored), at)
        valid, rejected = split_rows(stream, rules)
        io.drain(io.to_files(rejected.drop("_feed", "_batch_id"), self.path("quarantine")), self._checkpoint("quarantine"))
        unique = unique_events(valid, at, key, late)
        hot = measured_hot(self.spark.read.schema(stored).parquet(self.path("bronze")).filter(F.col(on).isNotNull()), [on], hot_rows)
        enriched = enrich(unique, static, on, "left", key, hot=hot).withColumns(dict(derived)).drop("_feed", "_batch_id")
        io.drain(io.to_files(enriched, self.path("silver")), self._checkpoint("silver"))

    def gold(self, schema: T.StructType, keys: Sequence[str], aggregates: Sequence[Column], parts: int = 8) -> DataFrame:
        """STR-15: running totals over all batches; returns the current table.

        Only the current value of a key is stored: each batch replaces those it changed.
        """
        stream = io.file_stream(self.spark, self.path("silver"), schema)
        totals = stream.groupBy(*keys).agg(*aggregates)
        buckets.ensure(self.spark, self.path("gold"), totals.schema, keys, parts)

        def replace(batch: DataFrame, batch_id: int) -> None:
            buckets.merge(batch.sparkSession, self.path("gold"), batch, keys, [], io.feed_of(batch), batch_id)

        io.drain(io.each_batch(totals, replace, "update"), self._checkpoint("gold"))
        return buckets.read(self.spark, self.path("gold"))


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], newest: Sequence[str], checkpoint: str) -> None:
    """STR-16: merge every micro-batch into the bucketed table at ``path`` (``operators.buckets``).

    Each batch rewrites the buckets of its keys only. ``newest`` names the
    columns that order the rows of a key; a row that arrives after a newer one is
    left out. A batch is known by the stream's checkpoint and its number, so one
    that runs again is recognised, and a second stream is not taken for it.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        buckets.merge(batch.sparkSession, path, batch, keys, newest, io.feed_of(batch), batch_id)

    io.drain(io.each_batch(stream, merge), checkpoint)
