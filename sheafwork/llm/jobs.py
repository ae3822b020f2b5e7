"""Spark helpers shared by the operators: settings, task numbers, offsets."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.session import apply_defaults
from sheafwork.workspace import stage

#: Bytes of an Arrow batch: keeps a batch of long texts small.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` begins with it."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def every(docs: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, then what the task has freed goes back to the system: workers live on for later stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def task_number() -> int:
    return TaskContext.get().partitionId()


def record(**columns) -> pa.RecordBatch:
    """A batch from named arrays."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def task_offsets(staged: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """What lies before each task, for every key: columns ``task``, ``by``, ``before``.

    ``staged`` was written with a ``task`` column. The result has one row for
    each task and key, so the running sum sees that many rows, not the data.
    Without keys the sums come to the driver, one number for each task.
    """
    totals = staged.groupBy("task", *by).agg(F.sum(value).alias("_sum"))
    if not by:
        # One number for each task; a window over them all would be a plan for one task.
        sums = sorted((r.task, int(r._sum or 0)) for r in totals.collect())
        before = [0, *accumulate(n for _, n in sums)]
        return staged.sparkSession.createDataFrame([(t, b) for (t, _), b in zip(sums, before)], "task long, before long")
    order = Window.partitionBy(*by).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("task", *by, F.coalesce(F.sum("_sum").over(order), F.lit(0)).cast("long").alias("before"))


__all__ = ["BATCH_BYTES", "prepare", "documents", "free", "every", "task_number", "record", "task_offsets", "tidy", "stage"]
