"""First-of-group and ordinal operators.

``row_number() <= n`` directly above the window lets Spark prune every group to ``n`` rows inside
each map task before the shuffle, so group size does not matter. Numbers without an upper limit go
through ``chunks.row_number_by_key``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY
from vitalgrid.operators import chunks


def top_per_group(
    df: DataFrame, keys: Sequence[str], by: Sequence[Column], n: int, out: str = "rn"
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)


def top1(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    return top_per_group(df, keys, by, 1, "_rn").drop("_rn")


def keep_latest(
    df: DataFrame, keys: Sequence[str], t: str, ties: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the latest time, larger tie-break values first, NULLs last."""
    return top1(df, keys, [F.col(c).desc_nulls_last() for c in (t, *ties)])


def spread_ordinals(
    df: DataFrame, keys: Sequence[str], by: Sequence[Column], value: str, n: int, prefix: str
) -> DataFrame:
    """The first ``n`` values of each group as columns ``prefix1`` .. ``prefixn``."""
    ranked = top_per_group(df, keys, by, n, "_rn")
    columns = [
        F.max(F.when(F.col("_rn") == i, F.col(value))).alias(f"{prefix}{i}")
        for i in range(1, n + 1)
    ]
    return ranked.groupBy(*keys).agg(*columns)


def rank_after_group(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    part: Sequence[str],
    t: str,
    ties: Sequence[str] = (),
    out: str = "rn",
    width: int | None = DAY,
) -> DataFrame:
    """Number grouped rows within a coarser key."""
    grouped = df.groupBy(*keys).agg(*aggregates)
    return chunks.row_number_by_key(grouped, part, t, out, ties, width)


def surrogate_id(
    df: DataFrame,
    part: Sequence[str],
    t: str,
    ties: Sequence[str] = (),
    out: str = "id",
    width: int | None = DAY,
) -> DataFrame:
    return chunks.row_number_by_key(df, part, t, out, ties, width)


def ordinal_within(
    df: DataFrame,
    part: Sequence[str],
    t: str,
    ties: Sequence[str] = (),
    out: str = "rn",
    width: int | None = DAY,
) -> DataFrame:
    return chunks.row_number_by_key(df, part, t, out, ties, width)


def lag_or(
    df: DataFrame,
    key: Sequence[str],
    t: str,
    fallback: str,
    out: str,
    ties: Sequence[str] = (),
    width: int | None = DAY,
) -> DataFrame:
    """Previous time of the key, or another column's value on its first row."""
    rows = chunks.neighbours(df, key, t, [t], ties, width=width)
    return rows.withColumn(out, F.coalesce(F.col(f"_prev.{t}"), F.col(fallback))).drop("_prev")


def next_start_as_end(
    df: DataFrame,
    key: Sequence[str],
    t: str,
    bound: str,
    out: str,
    ties: Sequence[str] = (),
    width: int | None = DAY,
) -> DataFrame:
    """Close each interval at the next start, the last one at an outer bound."""
    rows = chunks.neighbours(df, key, t, [t], ties, previous=None, following="_next", width=width)
    return rows.withColumn(out, F.coalesce(F.col(f"_next.{t}"), F.col(bound))).drop("_next")
