"""Ordered computations within groups (WIN).

Two situations are told apart:

* Groups with a bounded number of rows, such as a yearly or daily series after
  aggregation: native window functions.
* Groups of any size, such as ranking raw rows inside five segments or over the
  whole table: ``OrderedSlices``. Rows are range-partitioned by group and order,
  so a big group spans several slices; each slice is windowed on its own and
  small per-slice offsets join the slices up. No task ever holds a whole group.

``largest_group`` and ``fits`` measure which situation applies.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sheafwork import workspace

# Rows one task sorts and windows comfortably, with spilling.
ROWS_PER_SLICE = 20_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the biggest group (a combined count; one number reaches the driver)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def fits(df: DataFrame, keys: Sequence[str], limit: int = ROWS_PER_SLICE) -> bool:
    return largest_group(df, keys) <= limit


def previous_period(
    df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str], strict: bool = False
) -> DataFrame:
    """WIN-06/16: add ``<column>_prev`` from the preceding period of a series.

    ``strict`` accepts the preceding row only when it is exactly one period
    earlier; otherwise the preceding row counts, whatever its distance.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    step = F.col(period) - F.lag(period, 1).over(w)
    found = {}
    for c in columns:
        value = F.lag(c, 1).over(w)
        found[f"{c}_prev"] = F.when(step == 1, value) if strict else value
    return df.withColumns(found)


def index_to_base(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    """Each column relative to its first non-null value in the series, base 100."""
    whole = (
        Window.partitionBy(*keys).orderBy(period)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    base = {c: F.first(c, ignorenulls=True).over(whole) for c in columns}
    return df.withColumns(
        {f"{c}_idx": F.when(base[c] != 0, F.col(c) / base[c] * 100) for c in columns}
    )


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Sequence[Column]) -> DataFrame:
    """WIN-10/11: group aggregates repeated on every row of the group.

    Written as aggregate + join rather than an unordered window: the aggregate
    combines on the map side and the join spreads a hot group over tasks. The
    totals are staged, so that the planner knows their size: few groups are
    broadcast, and the rows are then not shuffled.
    """
    totals = workspace.stage(df.groupBy(*keys).agg(*stats), "group_stats")
    renamed = totals.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return df.join(renamed, match, "inner").drop(*[f"_g_{k}" for k in keys])


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """WIN-15: first ``n`` rows of every group, with their row number ``rnk``.

    The filter sits right on the window, so Spark keeps at most ``n`` candidates
    per group and map task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rnk", F.row_number().over(w)).filter(F.col("rnk") <= n)


def top_n_values(df: DataFrame, keys: Sequence[str], by: str, n: int) -> DataFrame:
    """WIN-14: all rows holding one of the ``n`` highest values of their group.

    Ranks distinct values (at most ``n`` per group and task reach the window) and
    joins the rows to them, so any number of ties is no load on a single task.
    """
    values = df.select(*keys, by).filter(F.col(by).isNotNull()).distinct()
    best = top_n(values, keys, [F.col(by).desc()], n)
    return df.join(best, [*keys, by], "inner")


@dataclass(frozen=True)
class OrderedSlices:
    """Rows staged by group and order, cut into contiguous slices.

    ``by`` is the ordering column (nulls last), ``tie`` columns make the order
    total. Build with ``OrderedSlices.build``.
    """

    staged: DataFrame
    keys: tuple[str, ...]
    by: str
    tie: tuple[str, ...]
    descending: bool

    @classmethod
    def build(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        by: str,
        tie: Sequence[str],
        descending: bool = False,
        slices: int | None = None,
    ) -> OrderedSlices:
        if slices is None:
            partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            slices = max(partitions, -(-df.count() // ROWS_PER_SLICE))
        order = _order(by, tie, descending)
        sliced = df.repartitionByRange(slices, *[F.col(k).asc() for k in keys], *order)
        staged = workspace.stage(sliced.withColumn("_slice", F.spark_partition_id()), "slices")
        return cls(staged, tuple(keys), by, tuple(tie), descending)

    def _local(self) -> Window:
        return Window.partitionBy("_slice", *self.keys).orderBy(*_order(self.by, self.tie, self.descending))

    def _across(self) -> Window:
        # Over the per-slice summary: at most one row per slice and group.
        return Window.partitionBy(*self.keys).orderBy("_slice")

    def _before(self) -> Window:
        return self._across().rowsBetween(Window.unboundedPreceding, -1)

    def _attach(self, offsets: DataFrame) -> DataFrame:
        """Join offsets to the rows.

        Only a group that began in an earlier slice has an offset row, and a
        slice can continue at most one group, so there are at most as many
        offset rows as slices: small enough to broadcast by construction.
        """
        names = ["_slice", *self.keys]
        right = offsets.withColumnsRenamed({c: f"_o_{c}" for c in names})
        match = F.lit(True)
        for c in names:
            match = match & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        return self.staged.join(F.broadcast(right), match, "left").drop(*[f"_o_{c}" for c in names])

    def ranked(self) -> DataFrame:
        """WIN-01..03, 13: add ``row_number``, ``rank`` and ``dense_rank``."""
        by = F.col(self.by)
        # Rows per distinct order value first: a value shared by very many rows
        # is already one row per slice here.
        values = self.staged.groupBy("_slice", *self.keys, by.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
        # Position of a value in the order, nulls last, as a comparable struct.
        place = F.struct(F.col("_v").isNull().alias("late"), F.col("_v").alias("v"))
        if self.descending:
            place = F.struct(F.col("_v").isNotNull().alias("late"), F.col("_v").alias("v"))
        first, last = (F.max_by, F.min_by) if self.descending else (F.min_by, F.max_by)
        cell = F.struct(F.col("_v").alias("v"), F.col("_c").alias("c"))
        per = values.groupBy("_slice", *self.keys).agg(
            F.sum("_c").alias("_n"),
            F.count(F.lit(1)).alias("_d"),
            first(cell, place).alias("_first"),
            last(cell, place).alias("_last"),
        )
        across = self._across()
        previous = F.lag("_last").over(across)
        # Does the slice open with the value the previous slice ended on?
        carried = previous.isNotNull() & F.col("_first.v").eqNullSafe(previous["v"])
        per = per.withColumns(
            {
                "_prior": F.sum("_n").over(self._before()),
                "_carried": carried,
                "_fresh": F.col("_d") - carried.cast("int"),
            }
        )
        one_value = F.col("_carried") & (F.col("_d") == 1)
        tail_rank = F.when(
            ~one_value, F.coalesce(F.col("_prior"), F.lit(0)) + F.col("_n") - F.col("_last.c") + 1
        )
        per = per.withColumn("_tail_rank", tail_rank)
        offsets = per.withColumns(
            {
                "_prior_d": F.sum("_fresh").over(self._before()),
                "_open_rank": F.last("_tail_rank", ignorenulls=True).over(self._before()),
            }
        ).filter(F.col("_prior").isNotNull()).select(
            "_slice", *self.keys, "_prior", "_prior_d", "_carried", "_open_rank",
            F.col("_first.v").alias("_open_v"),
        )
        ties = Window.partitionBy("_slice", *self.keys).orderBy(_order(self.by, (), self.descending)[0])
        rows = self._attach(offsets)
        prior = F.coalesce(F.col("_prior"), F.lit(0))
        in_carried = F.coalesce(F.col("_carried"), F.lit(False)) & by.eqNullSafe(F.col("_open_v"))
        dense_shift = F.coalesce(F.col("_prior_d"), F.lit(0)) - F.coalesce(F.col("_carried"), F.lit(False)).cast("int")
        return (
            rows.withColumns(
                {
                    "row_number": (prior + F.row_number().over(self._local())).cast("bigint"),
                    "rank": F.when(in_carried, F.col("_open_rank"))
                    .otherwise(prior + F.rank().over(ties)).cast("bigint"),
                    "dense_rank": (dense_shift + F.dense_rank().over(ties)).cast("bigint"),
                }
            ).drop("_slice", "_prior", "_prior_d", "_carried", "_open_rank", "_open_v")
        )

    def running_sum(self, column: str, name: str) -> DataFrame:
        """WIN-08: cumulative sum in order, rows frame; of the type that a plain sum has."""
        return self.running_sums({name: column})

    def running_sums(self, columns: Mapping[str, str]) -> DataFrame:
        """Cumulative sums of several columns in one pass; ``columns`` maps new names to columns."""
        totals = [F.sum(c).alias(f"_s_{n}") for n, c in columns.items()]
        kinds = self.staged.agg(*totals).schema
        per = self.staged.groupBy("_slice", *self.keys).agg(*totals)
        offsets = (
            per.withColumns({
                **{f"_prior_{n}": F.sum(f"_s_{n}").over(self._before()) for n in columns},
                "_seen": F.count(F.lit(1)).over(self._before()),
            })
            .filter(F.col("_seen") > 0)
            .select("_slice", *self.keys, *[f"_prior_{n}" for n in columns])
        )
        frame = self._local().rowsBetween(Window.unboundedPreceding, 0)

        def total(name: str, column: str) -> Column:
            local, prior = F.sum(column).over(frame), F.col(f"_prior_{name}")
            return F.when(local.isNull(), prior).otherwise(local + F.coalesce(prior, F.lit(0))).cast(kinds[f"_s_{name}"].dataType)

        found = self._attach(offsets).withColumns({n: total(n, c) for n, c in columns.items()})
        return found.drop("_slice", *[f"_prior_{n}" for n in columns])

    def neighbours(self, column: str, lag_name: str, lead_name: str) -> DataFrame:
        """WIN-06/07: value of the preceding and following row."""
        w = self._local()
        place = F.struct(
            *[
                (F.col(self.by).isNotNull() if self.descending else F.col(self.by).isNull()).alias("late"),
                F.col(self.by).alias("v"),
            ]
        )
        # Ends of each slice: order value first, then the tie-break columns.
        ends = self.staged.groupBy("_slice", *self.keys)
        if self.descending:
            per = self._ends_by_rank(column)
        else:
            spot = F.struct(place.alias("p"), *[F.col(t) for t in self.tie])
            per = ends.agg(
                F.min_by(F.struct(F.col(column).alias("x")), spot).alias("_head"),
                F.max_by(F.struct(F.col(column).alias("x")), spot).alias("_tail"),
            )
        across = self._across()
        offsets = (
            per.withColumns({"_in": F.lag("_tail").over(across), "_out": F.lead("_head").over(across)})
            .filter(F.col("_in").isNotNull() | F.col("_out").isNotNull())
            .select("_slice", *self.keys, "_in", "_out")
        )
        first_row = F.row_number().over(w) == 1
        last_row = F.lead(F.lit(1)).over(w).isNull()
        return (
            self._attach(offsets)
            .withColumns(
                {
                    lag_name: F.when(first_row, F.col("_in.x")).otherwise(F.lag(column).over(w)),
                    lead_name: F.when(last_row, F.col("_out.x")).otherwise(F.lead(column).over(w)),
                }
            )
            .drop("_slice", "_in", "_out")
        )

    def _ends_by_rank(self, column: str) -> DataFrame:
        # Descending order with ascending tie-breaks has no single comparable
        # struct; take the ends from the local row order instead.
        w = self._local()
        marked = self.staged.withColumns(
            {"_head_row": F.row_number().over(w) == 1, "_tail_row": F.lead(F.lit(1)).over(w).isNull()}
        ).filter(F.col("_head_row") | F.col("_tail_row"))
        value = F.struct(F.col(column).alias("x"))
        return marked.groupBy("_slice", *self.keys).agg(
            F.max(F.when(F.col("_head_row"), value)).alias("_head"),
            F.max(F.when(F.col("_tail_row"), value)).alias("_tail"),
        )


def _order(by: str, tie: Sequence[str], descending: bool) -> list[Column]:
    head = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return [head, *[F.col(t).asc() for t in tie]]


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    tie: Sequence[str],
    descending: bool = False,
    limit: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``row_number``, ``rank``, ``dense_rank`` within ``keys``.

    Measures the largest group: native windows when it fits one task, slices
    otherwise. Both give the same answer.
    """
    if not fits(df, keys, limit):
        return OrderedSlices.build(df, keys, by, tie, descending).ranked()
    w = Window.partitionBy(*keys).orderBy(_order(by, (), descending)[0])
    return df.withColumns(
        {
            "row_number": F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(by, tie, descending)))
            .cast("bigint"),
            "rank": F.rank().over(w).cast("bigint"),
            "dense_rank": F.dense_rank().over(w).cast("bigint"),
        }
    )


def running_sum(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str], column: str, name: str,
    limit: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Cumulative sum within ``keys``, split when a group is too big for a task."""
    if not fits(df, keys, limit):
        return OrderedSlices.build(df, keys, by, tie).running_sum(column, name)
    w = Window.partitionBy(*keys).orderBy(*_order(by, tie, False)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(column).over(w))


def neighbours(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str], column: str,
    lag_name: str, lead_name: str, limit: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Previous and next value within ``keys``, split when a group is too big."""
    if not fits(df, keys, limit):
        return OrderedSlices.build(df, keys, by, tie).neighbours(column, lag_name, lead_name)
    w = Window.partitionBy(*keys).orderBy(*_order(by, tie, False))
    return df.withColumns({lag_name: F.lag(column).over(w), lead_name: F.lead(column).over(w)})


#: Consecutive rows of a group that one window works on.
ROWS_PER_BLOCK = 1_000_000


def framed(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str], before: int, after: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]], block_rows: int = ROWS_PER_BLOCK, slices: int | None = None,
) -> DataFrame:
    """WIN-09: columns over the ``before`` preceding and ``after`` following rows, for groups of any size.

    ``columns`` maps names to functions of the window. Rows are numbered within
    their group by slices, and blocks of ``block_rows`` consecutive rows are
    windowed on their own. Each block also gets the rows of its neighbours
    that its edges need, as many as the frame is long.
    """
    size = max(block_rows, before, after, 1)
    numbered = OrderedSlices.build(df, keys, by, tie, slices=slices).ranked()
    at = F.col("row_number") - 1
    home, place = F.floor(at / size).cast("bigint"), at % size
    blocks = F.array(home, F.when(place >= size - before, home + 1), F.when((place < after) & (home > 0), home - 1))
    spread = numbered.withColumn("_home", home).withColumn("_block", F.explode(F.filter(blocks, lambda b: b.isNotNull())))
    window = Window.partitionBy(*keys, "_block").orderBy("row_number").rowsBetween(-before, after)
    return spread.withColumns({name: make(window) for name, make in columns.items()}).where("_block = _home").select(*df.columns, *columns)


def range_totals(
    df: DataFrame, keys: Sequence[str], by: Column, before: int, after: int, sums: Mapping[str, Column], name: str = "at"
) -> DataFrame:
    """WIN-12: for each group and whole number ``by``, sums over rows with ``by`` from ``-before`` to ``+after``.

    Rows of one value are added up first, on the map side, so a group that holds
    most rows leaves one row for each value. Values are cut into cells of the
    frame's length, so a frame is the end of one cell and the start of the next:
    each value asks both cells, which hold running sums from either side. A moving
    frame would be added up anew for every value. Nothing is subtracted, so
    sums of doubles keep their precision.
    """
    length = F.lit(before + after + 1).cast("bigint")
    one = df.groupBy(*keys, by.cast("bigint").alias(name)).agg(*[F.sum(c).alias(n) for n, c in sums.items()]).where(F.col(name).isNotNull())
    kinds = {f.name: f.dataType for f in one.agg(*[F.sum(n).alias(n) for n in sums]).schema}
    low, high = F.col(name) - F.lit(before).cast("bigint"), F.col(name) + F.lit(after).cast("bigint")

    def spot(asks: int, at: Column) -> Column:
        return F.struct(F.lit(asks).alias("asks"), at.alias("at"))

    # 0 brings its sums, 1 asks for its cell from ``at`` on, 2 for its cell up to ``at``; a frame that is a cell needs no second.
    spots = F.array(spot(0, F.col(name)), spot(1, low), F.when(F.pmod(low, length) != 0, spot(2, high)))
    placed = one.withColumn("_spot", F.explode(F.filter(spots, lambda s: s.isNotNull()))).select(
        *keys, name, F.col("_spot.asks").alias("_asks"), F.col("_spot.at").alias("_at"), *[F.when(F.col("_spot.asks") == 0, F.col(n)).alias(n) for n in sums]
    ).withColumn("_cell", F.col("_at") - F.pmod("_at", length))
    cell = Window.partitionBy(*keys, "_cell")
    up, down = (cell.orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.col("_at").asc(), F.col("_at").desc()))
    found = placed.select(
        *keys, name, "_asks", *[F.when(F.col("_asks") == 1, F.sum(n).over(down)).otherwise(F.sum(n).over(up)).alias(n) for n in sums]
    ).where("_asks > 0")
    return found.groupBy(*keys, name).agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in sums])


def ntile(row_number: Column, group_rows: Column, tiles: int) -> Column:
    """WIN-05: tile number from a row number and the group size."""
    small = F.floor(group_rows / tiles)
    bigger = group_rows % tiles  # the first tiles take one row more
    edge = bigger * (small + 1)
    return F.when(row_number <= edge, F.floor((row_number - 1) / (small + 1)) + 1).otherwise(
        bigger + F.floor((row_number - edge - 1) / F.greatest(small, F.lit(1))) + 1
    ).cast("bigint")


def percent_rank(rank: Column, group_rows: Column) -> Column:
    """WIN-04: (rank - 1) / (rows - 1), 0 for a single row."""
    return F.when(group_rows > 1, (rank - 1) / (group_rows - 1)).otherwise(F.lit(0.0))
