"""PIP-27: an ordered run of steps that stops at the first failure."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

STATUS_SCHEMA = (
    "position int, step string, status string, n_rows bigint, message string, started_at timestamp, finished_at timestamp"
)


@dataclass(frozen=True)
class Step:
    """A named job; ``job`` does the work and returns a row count (or None)."""

    name: str
    job: Callable[[], int | None]
    after: Sequence[str] = field(default_factory=tuple)


def run_steps(spark: SparkSession, steps: Sequence[Step]) -> DataFrame:
    """Run steps in the given order and return one status row per step.

    Every ``after`` name must come earlier in the list. Steps behind a failure
    are reported as skipped.
    """
    seen: set[str] = set()
    for step in steps:
        missing = [a for a in step.after if a not in seen]
        if missing:
            raise ValueError(f"{step.name} runs before {missing}")
        seen.add(step.name)
    rows, failed = [], False
    for position, step in enumerate(steps, 1):
        started = dt.datetime.now(dt.timezone.utc)
        status, n_rows, message = "skipped", None, None
        if not failed:
            try:
                n_rows, status = step.job(), "done"
            except Exception as e:  # the run report carries the failure
                status, message, failed = "failed", f"{type(e).__name__}: {e}", True
        rows.append((position, step.name, status, n_rows, message, started, dt.datetime.now(dt.timezone.utc)))
    return spark.createDataFrame(rows, STATUS_SCHEMA)
