"""Table-level results of update, delete, merge and version operations (VER).

The row operations map a table state to its next state. ``VersionedTable``
keeps states as Parquet folders ``v=N`` with a small history table beside them;
a version exists once its history row does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork.operators.dedup import require_unique


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """VER-01: set columns where the condition is true; null counts as not true."""
    hit = F.coalesce(condition, F.lit(False))
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.when(hit, e.cast(types[c])).otherwise(F.col(c)) for c, e in changes.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """VER-02: drop rows where the condition is true; null keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """VER-03/04: matched rows take source values, unmatched source rows are added.

    ``update`` and ``insert`` limit the columns that are taken (default: all);
    columns left out keep the target value, or are null in new rows. A repeated
    key in the source is an error.
    """
    require_unique(source, keys, "merge source")
    values = [c for c in target.columns if c not in keys]
    updates = set(values if update is None else update)
    inserts = set(values if insert is None else insert)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.select(*keys, *[c for c in source.columns if c in values]).withColumn("_in_s", F.lit(True)).alias("s")
    have = set(source.columns)
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()

    def merged(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c not in have:
            return old
        new = F.col(f"s.{c}").cast(target.schema[c].dataType)
        return (
            F.when(in_t & in_s, new if c in updates else old)
            .when(in_s, new if c in inserts else F.lit(None))
            .otherwise(old)
        )

    # Joined by name: the full join coalesces the key columns itself.
    return t.join(s, list(keys), "full").select(
        *[F.col(c) if c in keys else merged(c).alias(c) for c in target.columns]
    )


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """VER-09: insert, delete, update_preimage and update_postimage rows.

    All non-key columns are compared, null-safe.
    """
    values = [c for c in new.columns if c not in keys]

    def state(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(c) for c in values]).alias(name))

    both = state(old, "_old").join(state(new, "_new"), list(keys), "full")
    before, after = F.col("_old"), F.col("_new")

    def change(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), row.alias("row"))

    changes = (
        F.when(before.isNull(), F.array(change("insert", after)))
        .when(after.isNull(), F.array(change("delete", before)))
        .when(
            ~before.eqNullSafe(after),
            F.array(change("update_preimage", before), change("update_postimage", after)),
        )
    )
    return both.select(*keys, F.explode(changes).alias("c")).select(*keys, "c.change_type", "c.row.*")


def evolve(table: DataFrame, rows: DataFrame, merge_schema: bool = False) -> DataFrame:
    """VER-10: append with schema enforcement.

    New columns raise unless ``merge_schema``; a changed type always raises.
    """
    known = {f.name: f.dataType for f in table.schema.fields}
    extra = [f.name for f in rows.schema.fields if f.name not in known]
    changed = [f.name for f in rows.schema.fields if f.name in known and f.dataType != known[f.name]]
    if changed:
        raise ValueError(f"type differs from the table: {changed}")
    if extra and not merge_schema:
        raise ValueError(f"columns not in the table: {extra}")
    return table.unionByName(rows, allowMissingColumns=True)


_HISTORY = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


@dataclass(frozen=True)
class VersionedTable:
    """VER-05..08, 13: numbered snapshots of one table under ``path``."""

    spark: SparkSession
    path: str

    def _history_rows(self) -> DataFrame:
        return self.spark.read.schema(_HISTORY).option("ignoreMissingFiles", True).parquet(f"{self.path}/history")

    def history(self) -> DataFrame:
        """VER-07: one row per version."""
        return self._history_rows()

    def latest(self) -> int:
        return self._history_rows().agg(F.max("version")).first()[0]

    def create(self, df: DataFrame, at: dt.datetime | None = None) -> int:
        return self._publish(df, 0, "CREATE", at, "errorifexists")

    def commit(self, df: DataFrame, operation: str, at: dt.datetime | None = None) -> int:
        """VER-05: store ``df`` as the next version. ``df`` may read older versions.

        One writer at a time. A folder without a history row is what a failed
        commit left behind, and is replaced.
        """
        return self._publish(df, self.latest() + 1, operation, at, "overwrite")

    def append(self, rows: DataFrame, at: dt.datetime | None = None) -> int:
        return self.commit(evolve(self.read(), rows), "APPEND", at)

    def read(self, version: int | None = None) -> DataFrame:
        """VER-06: the state at ``version`` (default: newest)."""
        return self.spark.read.parquet(f"{self.path}/v={self.latest() if version is None else version}")

    def read_at(self, moment: dt.datetime) -> DataFrame:
        """VER-06: the newest state committed at or before ``moment``."""
        found = self._history_rows().filter(F.col("committed_at") <= F.lit(moment)).agg(F.max("version")).first()[0]
        if found is None:
            raise ValueError(f"no version at {moment}")
        return self.read(found)

    def restore(self, version: int, at: dt.datetime | None = None) -> int:
        """VER-08: an old state becomes the newest version."""
        return self.commit(self.read(version), f"RESTORE {version}", at)

    def expired(self, now: dt.datetime, keep_hours: float) -> DataFrame:
        """VER-13: versions older than the retention time, except the current one.

        This is the dry run; removing the folders is left to the storage tools.
        """
        limit = now - dt.timedelta(hours=keep_hours)
        return self._history_rows().filter(
            (F.col("committed_at") < F.lit(limit)) & (F.col("version") < F.lit(self.latest()))
        )

    def _publish(self, df: DataFrame, version: int, operation: str, at: dt.datetime | None, mode: str) -> int:
        folder = f"{self.path}/v={version}"
        df.write.mode(mode).parquet(folder)
        entry = (
            self.spark.read.parquet(folder)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(
                F.lit(version).cast("bigint").alias("version"),
                (F.lit(at) if at else F.current_timestamp()).alias("committed_at"),
                F.lit(operation).alias("operation"),
                "n_rows",
            )
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/history")
        return version
