"""Equi joins, set operations, ordering and previews."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_inner(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on if isinstance(on, str) else list(on), "inner")


def join_left(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on if isinstance(on, str) else list(on), "left")


def star_left(grid: DataFrame, features: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Attach features that are unique on ``on``, one left join each."""
    return reduce(lambda acc, feature: join_left(acc, feature, on), features, grid)


def star_merge(
    grid: DataFrame,
    features: Sequence[DataFrame],
    on: Sequence[str],
    aggregates: Sequence[Column],
    deal: Sequence[str] = (),
    parts: int | None = None,
    grow: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``star_left`` as one shuffle: stack grid and raw feature rows, aggregate, keep grid keys.

    Features need not be unique: ``aggregates`` reduces them in the same pass. With ``deal``, some of
    ``on``, rows are dealt by those columns into ``parts`` tasks, and windows over them need no shuffle
    of their own; ``grow`` makes the rows of a grid that is dealt before it grows.
    """
    grid_columns = [c for c in (grow(grid) if grow else grid).columns if c not in on]
    stacked = grid.withColumn("_grid", F.lit(True))
    for feature in features:
        stacked = stacked.unionByName(feature, allowMissingColumns=True)
    if deal:
        stacked = stacked.repartition(*([parts] if parts else []), *deal)
    if grow:
        stacked = grow(stacked)
    return (
        stacked.groupBy(*on)
        .agg(
            F.max("_grid").alias("_grid"),
            *[F.max(c).alias(c) for c in grid_columns],
            *aggregates,
        )
        .where("_grid")
        .drop("_grid")
    )


def semi_pair(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key combination occurs in ``dim``; NULL keys never match."""
    return df.join(dim.select(*keys).distinct(), list(keys), "left_semi")


def outer_pairs(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """A full join that is filtered to present left rows afterwards, stated as the left join it is."""
    return join_left(left, right, on)


def union_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select(*keys) for f in frames]).distinct()


def union_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def top_n(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order; each task keeps only ``n`` rows before the merge."""
    return df.orderBy(*by).limit(n)


def limit(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
