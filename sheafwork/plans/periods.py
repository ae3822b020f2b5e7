"""Layers by period, of which a run recomputes only those that changed (PIP-24, PIP-25).

Raw rows stream into bronze under their period (a day, or a longer calendar
unit). Each batch notes the periods it touched. ``refresh`` takes the noted
batches that it has not seen, reads the bronze rows of their periods only and
replaces these periods in silver and gold.

Copies of an order carry the same event time, so they meet in one period, and a
period can be made unique by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.streaming import io

PERIOD = "_period"
# Units of which there are so few that each task may write a file for every one; rows of shorter ones are gathered first.
LONG_UNITS = ("month", "quarter", "year")
_BATCH = "_feed string, _batch_id bigint"


def period_of(moment: Column, unit: str) -> Column:
    """First day of the calendar unit (``day``, ``month``, ...); null when the moment is unreadable."""
    return F.to_date(F.date_trunc(unit, moment.try_cast("timestamp_ntz")))


@dataclass(frozen=True)
class PeriodTable:
    """Rows in folders by run, period and further columns; a period's rows are those of its newest run.

    A run counts once its periods are noted, after its rows are there; what a run
    that broke off has written is never read.
    """

    spark: SparkSession
    path: str
    partition_by: Sequence[str] = ()

    def replace(self, rows: DataFrame, periods: DataFrame, run: int) -> None:
        """Put ``rows`` (with ``_period``) in the place of all rows of ``periods``."""
        folders = ["_run", PERIOD, *self.partition_by]
        # Few files for each folder; adaptive execution splits a period that holds much. The run is not shuffled with the rows.
        tagged = rows.hint("rebalance", PERIOD, *self.partition_by).withColumn("_run", F.lit(run))
        tagged.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/schema")
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{self.path}/rows")
        noted = periods.select(PERIOD).distinct().withColumn("run", F.lit(run))
        noted.coalesce(1).write.mode("append").parquet(f"{self.path}/periods")

    def current(self) -> DataFrame:
        """Newest run of each period."""
        return self.spark.read.schema(f"{PERIOD} date, run int").parquet(f"{self.path}/periods").groupBy(PERIOD).agg(F.max("run").alias("_run"))

    def read(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        # One row for each period of the calendar: folders of older runs are pruned.
        return rows.join(F.broadcast(self.current()), ["_run", PERIOD]).drop("_run")


@dataclass(frozen=True)
class PeriodFlow:
    """Bronze fed by streams, and tables derived from it, below ``root``."""

    spark: SparkSession
    root: str
    unit: str = "day"

    def bronze(self, stream: DataFrame, moment: str, checkpoint: str) -> None:
        """Drain ``stream`` into bronze by period, feed and batch; a batch that runs again replaces what it wrote."""

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = batch.withColumn(PERIOD, period_of(F.col(moment), self.unit))
            if self.unit not in LONG_UNITS:
                rows = rows.hint("rebalance", PERIOD)
            # The names of the batch are not shuffled with the rows.
            feed = io.feed_of(batch)
            tagged = rows.withColumns({"_feed": F.lit(feed), "_batch_id": F.lit(batch_id).cast("bigint")})
            tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD, "_feed", "_batch_id").parquet(
                f"{self.root}/bronze"
            )
            # The folders name the periods; no column is read.
            written = batch.sparkSession.read.schema(f"{PERIOD} date, {_BATCH}").parquet(f"{self.root}/bronze")
            mine = written.where((F.col("_feed") == feed) & (F.col("_batch_id") == batch_id))
            io.batch_writer(f"{self.root}/touched")(mine.select(PERIOD).distinct().coalesce(1), batch_id)

        io.drain(io.each_batch(stream, write), checkpoint)

    def refresh(
        self, clean: Callable[[DataFrame], DataFrame], silver: PeriodTable, gold: PeriodTable, summarise: Callable[[DataFrame], DataFrame]
    ) -> list:
        """Recompute what new batches touched; returns the periods.

        ``clean`` maps bronze rows to silver rows and ``summarise`` silver rows to
        gold rows; both keep ``_period``.
        """
        self.spark.createDataFrame([], _BATCH).write.mode("append").parquet(f"{self.root}/seen")
        touched = self.spark.read.schema(f"{PERIOD} date, {_BATCH}").parquet(f"{self.root}/touched")
        seen = self.spark.read.schema(_BATCH).parquet(f"{self.root}/seen")
        new = workspace.stage(touched.join(seen, ["_feed", "_batch_id"], "left_anti"), "touched")
        # Calendar units, as many as the new rows span. Unreadable moments are in the null period, which no layer above takes.
        periods = sorted(r[0] for r in new.select(PERIOD).distinct().collect() if r[0])
        if periods:
            listed = self.spark.createDataFrame([(p,) for p in periods], f"{PERIOD} date")
            run = 1 + max((r[0] for r in self._runs(silver)), default=0)
            rows = self.spark.read.parquet(f"{self.root}/bronze").where(F.col(PERIOD).isin(periods)).drop("_feed", "_batch_id")
            silver.replace(clean(rows), listed, run)
            gold.replace(summarise(silver.read().where(F.col(PERIOD).isin(periods))), listed, run)
        new.select("_feed", "_batch_id").distinct().coalesce(1).write.mode("append").parquet(f"{self.root}/seen")
        return periods

    def _runs(self, table: PeriodTable) -> list:
        self.spark.createDataFrame([], f"{PERIOD} date, run int").write.mode("append").parquet(f"{table.path}/periods")
        return self.spark.read.schema("run int").parquet(f"{table.path}/periods").agg(F.coalesce(F.max("run"), F.lit(0))).collect()
