"""Grouped aggregates. All of them reduce on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out or value))


def sum_distinct_by(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum_distinct(F.col(value)).alias(out))


def conditional_sums(
    df: DataFrame, keys: Sequence[str], conditions: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Several sums in one pass; each maps a name to (condition, value)."""
    sums = [F.sum(F.when(c, v)).alias(name) for name, (c, v) in conditions.items()]
    return df.groupBy(*keys).agg(*sums)


def time_bounds(
    df: DataFrame, keys: Sequence[str], t: str, first: str = "first_t", last: str = "last_t"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(t).alias(first), F.max(t).alias(last))


def any_flag(df: DataFrame, keys: Sequence[str], condition: Column, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(F.when(condition, 1).otherwise(0)).alias(out))


def constant_in_group(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], count: str | None = None
) -> DataFrame:
    """One row per key for columns known to hold one value per key; NULLs are ignored. The rows of
    a key are counted in the same pass where ``count`` names a column for it."""
    counted = [F.count(F.lit(1)).alias(count)] if count else []
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns], *counted)


def preagg(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Make a join side unique on its keys before it is joined."""
    return df.groupBy(*keys).agg(*aggregates)


def having(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], condition: Column
) -> DataFrame:
    return df.groupBy(*keys).agg(*aggregates).where(condition)


def count_by(df: DataFrame, keys: Sequence[str] = (), out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
