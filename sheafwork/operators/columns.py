"""Projection, predicates, null handling and code lookups (PRJ)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def share_pct(part: Column, total: Column, digits: int = 2) -> Column:
    """PRJ-16: ``part`` as a percentage of ``total``; null unless total > 0.

    Divides as double: a decimal quotient of two wide sums keeps too few digits.
    """
    return F.round(F.when(total > 0, part.cast("double") / total.cast("double") * 100), digits)


def growth_pct(now: Column, before: Column, digits: int = 2) -> Column:
    """Percentage change against ``before``; null unless before > 0."""
    return F.round(F.when(before > 0, (now - before).cast("double") / before.cast("double") * 100), digits)


def literal_map(mapping: Mapping[str, str]) -> Column:
    """PRJ-17: a small fixed code table as a map column."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def add_lookups(df: DataFrame, code: str, **tables: Mapping[str, str]) -> DataFrame:
    """Add one column per lookup table; unknown codes become null."""
    return df.withColumns({name: literal_map(m)[F.col(code)] for name, m in tables.items()})


def unmapped_codes(df: DataFrame, code: str, known: Sequence[str]) -> DataFrame:
    """PRJ-18: the distinct non-null codes missing from ``known``."""
    return df.filter(~F.col(code).isin(*known)).select(code).distinct()


def try_cast_columns(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """PRJ-05: cast columns in place; a value that does not parse becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in targets.items()})


def bands(value: Column, edges: Sequence[tuple[float, str]], otherwise: str, inclusive: bool = False) -> Column:
    """PRJ-06: label by the first upper edge that ``value`` stays below.

    With ``inclusive`` an edge belongs to the band below it. A null value has no
    band.
    """
    chain = F.when(value.isNull(), F.lit(None))
    for edge, label in edges:
        chain = chain.when(value <= edge if inclusive else value < edge, label)
    return chain.otherwise(otherwise)


def hash_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A stable bucket number in [0, buckets) for a row's key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def hash_sample(df: DataFrame, keys: Sequence[str], percent: int) -> DataFrame:
    """PRJ-19: repeatable sample; a key is always in or always out."""
    return df.filter(hash_bucket(keys, 100) < percent)


def digest_sample(df: DataFrame, keys: Sequence[str], percent: float) -> DataFrame:
    """PRJ-19: repeatable sample by the first 32 bits of the keys' MD5, which other engines can draw as well.

    Key values are joined by ``|`` as text; a null key counts as empty.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    limit = f"{min(int(percent / 100 * 2**32), 2**32 - 1):08x}"
    return df.filter(F.substring(F.md5(text), 1, 8) < limit)


def random_sample(df: DataFrame, fraction: float, seed: int, replacement: bool = False) -> DataFrame:
    """PRJ-19: seeded random sample."""
    return df.sample(withReplacement=replacement, fraction=fraction, seed=seed)


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """PRJ-12: per-column null replacement."""
    return df.na.fill(dict(defaults))


def replace_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """PRJ-13: swap listed values in one column."""
    return df.na.replace(dict(mapping), subset=[column])


def drop_null_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """PRJ-11: drop rows with any / only null values, on all or some columns."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def same_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the names, order and types of ``schema``."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
