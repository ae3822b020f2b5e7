"""Join shapes beyond a plain ``df.join`` (JON)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork import workspace
from sheafwork.operators.windows import OrderedSlices

BROADCAST_BYTES = 32 << 20


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left", max_rows: int = 100_000
) -> DataFrame:
    """JON-10: broadcast ``dim`` after checking that it is small, in rows and in bytes.

    The check reads at most ``max_rows`` + 1 rows of ``dim``. A larger dimension
    is left to the ordinary shuffle join.
    """
    on = [on] if isinstance(on, str) else list(on)
    return fact.join(_small(dim, max_rows), on, how)


def _small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows and ``BROADCAST_BYTES`` as text."""
    width = F.octet_length(F.to_json(F.struct("*")))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= BROADCAST_BYTES else df


def hinted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, strategy: str) -> DataFrame:
    """JON-11: join with an explicit strategy (``merge`` or ``shuffle_hash``)."""
    if strategy not in ("merge", "shuffle_hash"):
        raise ValueError("strategy must be 'merge' or 'shuffle_hash'")
    return left.join(right.hint(strategy), list(on), how)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """JON-13: equi-join in which a null key matches a null key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def join_sizes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-14: rows each key would produce in an inner join, without joining them."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right"))
    return a.join(b, list(keys), "inner").withColumn("n_joined", F.col("n_left") * F.col("n_right"))


def range_lookup(
    fact: DataFrame, value: Column, ranges: DataFrame, low: str, high: str, width: float, max_rows: int = 100_000
) -> DataFrame:
    """JON-15: match each fact row to the range [low, high) that holds ``value``.

    Both sides get grid cells of the given width, which turns the inequality
    into an equi-join on the cell plus a residual filter. ``ranges`` must not
    overlap; facts outside every range keep null range columns. Each range is
    copied once per cell it touches, so choose ``width`` near the usual range
    size. A grid of at most ``max_rows`` rows is broadcast, so facts crowded into
    one cell stay where they are.
    """
    cell = F.floor(value / F.lit(width)).cast("bigint")
    last_cell = F.ceil(F.col(high) / F.lit(width)).cast("bigint") - 1
    first_cell = F.floor(F.col(low) / F.lit(width)).cast("bigint")
    grid = ranges.withColumn("_cell", F.explode(F.sequence(first_cell, F.greatest(first_cell, last_cell))))
    keyed = fact.withColumns({"_cell": cell, "_value": value})
    inside = (
        (F.col("f._cell") == F.col("g._cell"))
        & (F.col("f._value") >= F.col(f"g.{low}"))
        & (F.col("f._value") < F.col(f"g.{high}"))
    )
    return keyed.alias("f").join(_small(grid, max_rows).alias("g"), inside, "left").drop("_cell", "_value")


def dyadic_cells(low: Column, high: Column) -> Column:
    """Aligned cells that make up the whole numbers in [low, high): structs of ``level`` and ``cell``.

    A cell of level k holds 2^k numbers. At most two cells of a level are needed,
    so there are at most 2 log2(high - low) of them, however wide the range.
    """

    def of_level(k: Column) -> Column:
        first, end = -F.call_function("shiftright", -low, k), F.call_function("shiftright", high, k)

        def cell(at: Column, taken: Column) -> Column:
            return F.when((first < end) & taken, F.struct(k.alias("level"), at.alias("cell")))

        return F.array(cell(first, first % 2 != 0), cell(end - 1, end % 2 != 0))

    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(62)), of_level))
    return F.filter(cells, lambda c: c.isNotNull())


def range_join(
    fact: DataFrame, value: Column, ranges: DataFrame, low: str, high: str, unit: float, max_rows: int = 100_000
) -> DataFrame:
    """JON-15: each fact row with every range [low, high) that holds ``value``; ranges may overlap and differ in width.

    Ranges are cut into aligned cells of growing size, in units of ``unit``; a
    fact row looks up one cell of every level that occurs, so the inequality
    becomes an equi-join on level and cell with a residual filter. A range has
    at most 2 log2(width / unit) copies and a fact row one for each level.
    """
    first = F.floor(F.col(low) / F.lit(unit)).cast("bigint")
    end = F.ceil(F.col(high) / F.lit(unit)).cast("bigint")
    # Kept as a column, so that the cells are worked out once.
    celled = ranges.where(F.col(low) < F.col(high)).withColumn("_cells", dyadic_cells(first, end))
    cells = workspace.stage(celled.select("*", F.explode("_cells").alias("_c")).select("*", "_c.level", "_c.cell").drop("_cells", "_c").withColumnsRenamed(
        {"level": "_level", "cell": "_cell"}
    ), "range_cells")
    # No more than 63 numbers.
    levels = sorted(r[0] for r in cells.select("_level").distinct().collect())
    place = F.floor(value / F.lit(unit)).cast("bigint")
    asked = fact.withColumns({"_value": value, "_place": place}).withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    asked = asked.withColumn("_cell", F.expr("shiftright(_place, _level)"))
    met = asked.join(_small(cells, max_rows), ["_level", "_cell"])
    inside = (F.col("_value") >= F.col(low)) & (F.col("_value") < F.col(high))
    return met.where(inside).drop("_level", "_cell", "_value", "_place")


def range_sums(
    fact: DataFrame, value: Column, ranges: DataFrame, low: str, high: str, sums: Mapping[str, Column]
) -> DataFrame:
    """JON-15: each range [low, high) with sums over the fact rows whose ``value`` it holds; ranges that hold none are left out.

    The aggregate of ``range_join`` without its pairs, of which there are ranges
    times facts where ranges are wide. Facts of one value are added up first;
    then values and bounds are sorted together in slices, and a range is the
    running sum before its upper bound less that before its lower bound. Work
    grows with facts plus ranges. The sums must be exact: whole numbers or decimals.
    """
    parts = {**{f"_sum_{n}": F.sum(c) for n, c in sums.items()}, **{f"_n_{n}": F.count(c) for n, c in sums.items()}, "_rows": F.count(F.lit(1))}
    one = fact.groupBy(value.alias("_at")).agg(*[a.alias(n) for n, a in parts.items()]).where(F.col("_at").isNotNull())
    if inexact := [n for n in sums if one.schema[f"_sum_{n}"].dataType.typeName() not in ("long", "decimal")]:
        raise ValueError(f"sums must be whole numbers or decimals: {inexact}")
    # Staged, so that the numbers stay with their rows.
    numbered = workspace.stage(ranges.where(F.col(low) < F.col(high)).withColumn("_range", F.monotonically_increasing_id()), "ranges")
    ends = F.array(*[F.struct(F.lit(upper).alias("upper"), F.col(c).alias("at")) for c, upper in ((low, False), (high, True))])
    bounds = numbered.select("_range", F.explode(ends).alias("_end")).select("_range", F.col("_end.upper").alias("_upper"), F.col("_end.at").alias("_at"))
    # Bounds come before facts of their value.
    line = one.withColumn("_fact", F.lit(True)).unionByName(bounds.withColumn("_fact", F.lit(False)), allowMissingColumns=True)
    before = OrderedSlices.build(line, [], "_at", ["_fact"]).running_sums({f"{n}_before": n for n in parts}).where(~F.col("_fact"))

    def held(n: str) -> Column:
        at = F.coalesce(f"{n}_before", F.lit(0))
        return F.sum(F.when(F.col("_upper"), at).otherwise(-at)).alias(n)

    found = before.groupBy("_range").agg(*[held(n) for n in parts]).where(F.col("_rows") > 0)
    totals = [F.when(F.col(f"_n_{n}") > 0, F.col(f"_sum_{n}")).alias(n) for n in sums]
    return numbered.join(found, "_range").select(*ranges.columns, *totals)


def densify(df: DataFrame, keys: Sequence[str], period: str, first: int, last: int) -> DataFrame:
    """Every key with every period in [first, last]; measures are null where absent.

    The grid is each distinct key with a generated array of periods, so no
    cross join takes place.
    """
    grid = (
        df.select(*keys)
        .distinct()
        .withColumn(period, F.explode(F.sequence(F.lit(first), F.lit(last))))
        .withColumn(period, F.col(period).cast(df.schema[period].dataType))
    )
    return grid.join(df, [*keys, period], "left")
