"""Look-back operators with an age limit: one shuffle on (key, time block), no pair generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY, micros
from vitalgrid.operators import chunks
from vitalgrid.operators.chunks import order_last, with_halo


def asof_lookback(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_t: str,
    right_t: str,
    columns: Sequence[str],
    max_age: int,
    width: int | None = DAY,
) -> DataFrame:
    """Attach the latest right row with left_t - max_age <= right_t <= left_t.

    ``right`` must be unique on (keys, right_t). Left rows without a match are kept. Both sides
    are stacked per (key, block) and the last right row is carried forward by a running window. With
    ``width`` None right rows are numbered in blocks of equal depth, and a left row meets the one
    that bears the number of right rows up to it.
    """
    keys = list(keys)
    if width is None:
        return _asof_by_number(left, right, keys, left_t, right_t, columns, max_age)
    seen = F.struct(F.col(right_t).alias("_t"), *columns)
    events = with_halo(
        right.where(F.col(right_t).isNotNull()).select(*keys, right_t, *columns),
        micros(right_t),
        width,
        max_age,
    ).select(*keys, "_block", micros(right_t).alias("_pos"), seen.alias("_seen"))
    probes = (
        with_halo(left, micros(left_t), width, 0)
        .drop("_own")
        .withColumn("_pos", micros(left_t))
        .withColumn("_probe", F.lit(1))
    )
    both = probes.unionByName(events.withColumn("_probe", F.lit(0)), allowMissingColumns=True)
    upto = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_pos", "_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = both.withColumn("_last", F.last("_seen", ignorenulls=True).over(upto)).where(
        F.col("_probe") == 1
    )
    fresh = (F.col("_pos") - micros("_last._t") <= max_age) & F.lit(True)
    for k in keys:  # a missing key or time equals nothing
        fresh = fresh & F.col(k).isNotNull()
    return carried.select(
        *left.columns, *[F.when(fresh, F.col(f"_last.{c}")).alias(c) for c in columns]
    )


def _asof_by_number(left, right, keys, left_t, right_t, columns, max_age) -> DataFrame:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    seen = right.where(F.col(right_t).isNotNull() & known).select(
        *keys, micros(right_t).alias("_pos"), F.struct(*columns).alias("_seen")
    )
    asked = left.where(F.col(left_t).isNotNull() & known).select(*keys, micros(left_t).alias("_pos"))
    positions = (
        seen.select(*keys, "_pos", F.lit(1).alias("_n"))
        .unionByName(asked.withColumn("_n", F.lit(0)))
        .groupBy(*keys, "_pos")
        .agg(F.sum("_n").alias("_n"))
    )
    numbered = chunks.running_number(positions, keys, "_pos", "_n", "_number")
    rights = seen.join(numbered, [*keys, "_pos"]).select(
        *keys, "_number", F.col("_pos").alias("_at"), "_seen"
    )
    names = [f"_k_{k}" for k in keys]
    answers = (
        numbered.join(rights, [*keys, "_number"])
        .where(F.col("_pos") - F.col("_at") <= max_age)
        .select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "_pos", "_seen")
    )
    same = micros(left_t) == F.col("_pos")
    for k, n in zip(keys, names, strict=True):
        same = same & (F.col(k) == F.col(n))
    return left.join(answers, same, "left").select(*left.columns, *[F.col(f"_seen.{c}").alias(c) for c in columns])


def prev_within(
    df: DataFrame,
    key: str,
    t: str,
    columns: Sequence[str],
    max_age: int,
    prefix: str = "prev_",
    ties: Sequence[str] = (),
    width: int | None = DAY,
) -> DataFrame:
    """The previous row of the key when it is younger than ``max_age``, as prefixed columns."""
    if width is None:
        near = chunks.neighbours(df, [key], t, list(dict.fromkeys([t, *columns])), ties, "_before", width=None)
        young = (micros(t) - micros(f"_before.{t}") < max_age) & F.col(key).isNotNull()
        return near.select(
            *df.columns, *[F.when(young, F.col(f"_before.{c}")).alias(prefix + c) for c in columns]
        )
    placed = with_halo(df, micros(t), width, max_age)
    inside = Window.partitionBy(key, "_block").orderBy(*order_last([t, *ties]))
    before = F.lag(F.struct(F.col(t).alias("_t"), *columns)).over(inside)
    rows = placed.withColumn("_before", before).where("_own")
    young = (
        (micros(t) - micros("_before._t") < max_age)
        & F.col(key).isNotNull()
    )
    return rows.select(
        *df.columns, *[F.when(young, F.col(f"_before.{c}")).alias(prefix + c) for c in columns]
    )
