"""Stream sources, triggers and sinks (STR-01..07, 13, 17)."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """STR-01/02: files as a stream; each file is read exactly once per checkpoint.

    ``path`` may be a folder or a glob. Without a rate limit, everything present
    at the start of a run forms one micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def rate_stream(spark: SparkSession, rows_per_second: int, partitions: int | None = None) -> DataFrame:
    """STR-03: generated rows (timestamp, value) by wall clock."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def bounded_rate_stream(spark: SparkSession, rows_per_batch: int, start: str = "2024-01-01 00:00:00") -> DataFrame:
    """STR-03: generated rows, a fixed number in every micro-batch."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", int(_epoch_ms(start)))
        .load()
    )


def _epoch_ms(moment: str) -> float:
    import datetime as dt

    return dt.datetime.fromisoformat(moment).replace(tzinfo=dt.timezone.utc).timestamp() * 1000


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Make ``column`` usable as event time: watermarks need a zoned timestamp."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """STR-05/07: process everything that is available, then stop.

    Run again with the same checkpoint, it picks up only what arrived since.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@contextmanager
def rows_only(spark: SparkSession) -> Iterator[None]:
    """Streams started inside run no batch without rows, which only removes state that the last rows made obsolete.

    For streams whose result is whole once their rows are processed, such as inner
    joins; the next batch with rows removes that state.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_continuously(writer: DataStreamWriter, checkpoint: str, every: str) -> StreamingQuery:
    """STR-05: a micro-batch per interval until stopped."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def run_without_batches(writer: DataStreamWriter, checkpoint: str, every: str) -> StreamingQuery:
    """STR-05: continuous processing until stopped; ``every`` is how often progress is saved.

    Rows pass through long-running tasks one by one, at least once. Spark allows
    this for maps and filters, from sources such as ``rate_stream`` to sinks that
    support it; each source partition holds a core all the time.
    """
    return writer.option("checkpointLocation", checkpoint).trigger(continuous=every).start()


def to_files(stream: DataFrame, path: str, fmt: str = "parquet") -> DataStreamWriter:
    """STR-06: append to files, exactly once."""
    return stream.writeStream.outputMode("append").format(fmt).option("path", path)


def drain_to_table(stream: DataFrame, name: str, checkpoint: str, path: str | None = None) -> StreamingQuery:
    """STR-06: append everything that is available to a catalog table, creating it on first use; exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    query = writer.trigger(availableNow=True).toTable(name)
    query.awaitTermination()
    return query


def whole_results(path: str) -> Callable[[DataFrame, int], None]:
    """STR-04: a foreachBatch job for complete mode, which hands over the whole result in every batch.

    Results take turns in two folders, and a batch counts once its number is
    noted. So readers of ``current_result`` see a whole result at any time, and
    no more than two are kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/turn={batch_id % 2}")
        noted = batch.sparkSession.createDataFrame([(batch_id,)], "batch_id bigint")
        noted.coalesce(1).write.mode("append").parquet(f"{path}_batches")

    return write


def current_result(spark: SparkSession, path: str) -> DataFrame:
    newest = spark.read.schema("batch_id bigint").parquet(f"{path}_batches").agg(F.max("batch_id")).first()[0]
    return spark.read.parquet(f"{path}/turn={newest % 2}")


def each_batch(
    stream: DataFrame, work: Callable[[DataFrame, int], None], mode: str = "append"
) -> DataStreamWriter:
    """STR-06: hand every micro-batch to a batch job."""
    return stream.writeStream.outputMode(mode).foreachBatch(work)


def feed_of(batch: DataFrame) -> str:
    """Id of the checkpoint a micro-batch belongs to: the same after a restart, another for every other stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """STR-13: a foreachBatch job that stores the batch under its ``_feed`` and ``_batch_id``.

    A batch that is run again after a failure overwrites its own partition, so
    the rows are there once. Streams with checkpoints of their own do not
    overwrite each other.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumns({"_feed": F.lit(feed_of(batch)), "_batch_id": F.lit(batch_id).cast("bigint")})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_feed", "_batch_id")
            .parquet(path)
        )

    return write


def stored_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``batch_writer`` with the columns of all batches."""
    return spark.read.option("mergeSchema", True).parquet(path)


def latest_state(updates: DataFrame, keys: list[str]) -> DataFrame:
    """STR-15: current value per key from the batches of one update-mode query."""
    values = [c for c in updates.columns if c not in keys and c not in ("_feed", "_batch_id")]
    newest = F.max_by(F.struct(*values), F.col("_batch_id")).alias("_v")
    return updates.groupBy(*keys).agg(newest).select(*keys, "_v.*")


class BatchLog(StreamingQueryListener):
    """Input and dropped rows of every micro-batch of a session's streams, however many there are."""

    def __init__(self) -> None:
        self.rows: dict[str, list[tuple[int, int, int]]] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rows.setdefault(str(p.runId), []).append((p.batchId, p.numInputRows, dropped))

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def of(self, query: StreamingQuery, seconds: float = 60) -> list[tuple[int, int, int]]:
        """Rows of an ended query; its end is reported after all its batches."""
        run = str(query.runId)
        with self._news:
            if not self._news.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"no end reported for stream {run}")
        return self.rows.get(run, [])


def drain_logged(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> DataFrame:
    """STR-17: ``drain``, returning one row per micro-batch with its input and dropped rows."""
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        rows = log.of(drain(writer, checkpoint))
    finally:
        spark.streams.removeListener(log)
    return spark.createDataFrame(rows, "batch_id bigint, input_rows bigint, dropped_rows bigint")


def active_queries(spark: SparkSession) -> list[str]:
    """STR-17: names (or ids) of the running queries."""
    return sorted(q.name or str(q.id) for q in spark.streams.active)


def check_columns(batch: DataFrame, text: str, schema: T.StructType, policy: str) -> DataFrame:
    """STR-02: apply a new-column policy to a batch of raw JSON text.

    ``none`` ignores unknown fields, ``failOnNewColumns`` raises, ``rescue``
    keeps them as JSON in ``_rescued``, ``addNewColumns`` adds string columns.
    """
    raw = batch.withColumn("_all", F.from_json(text, T.MapType(T.StringType(), T.StringType())))
    known = [f.name for f in schema.fields]
    extra = F.map_filter("_all", lambda k, _: ~k.isin(*known))
    rows = raw.select("*", F.from_json(text, schema).alias("_row"), extra.alias("_extra"))
    kept = [F.col(f"_row.{c}").alias(c) for c in known]
    if policy == "none":
        return rows.select(*kept)
    if policy == "rescue":
        return rows.select(*kept, F.when(F.size("_extra") > 0, F.to_json("_extra")).alias("_rescued"))
    # Field names are schema, not data: each becomes a column of the batch.
    found = rows.select(F.explode(F.map_keys("_extra")).alias("name")).distinct().orderBy("name")
    names = [r[0] for r in found.collect()]
    if policy == "failOnNewColumns":
        if names:
            raise ValueError(f"new columns: {names}")
        return rows.select(*kept)
    if policy == "addNewColumns":
        return rows.select(*kept, *[F.try_element_at("_extra", F.lit(n)).alias(n) for n in names])
    raise ValueError(f"unknown policy {policy!r}")
