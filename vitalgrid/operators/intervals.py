"""Joins between points in time and intervals, met on (key, time block)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY, block, micros, shift, shift_months


SHORT = 16  # blocks an interval may touch to be listed block by block
RADIX = 16
LEVELS = 8  # cells of 16**7 days hold any two times there are


def _cells(first: Column, last: Column) -> Column:
    """(level, cell) of the cells that cover a run of blocks: cells hold RADIX**level blocks each, at
    the level where at most RADIX + 1 of them suffice."""
    level = F.lit(LEVELS - 1)
    for n in range(LEVELS - 2, -1, -1):
        level = F.when(last - first < RADIX ** (n + 1), F.lit(n)).otherwise(level)
    size = F.element_at(F.array(*[F.lit(RADIX**n) for n in range(LEVELS)]), level + 1)
    return F.transform(
        F.sequence(_floor(first, size), _floor(last, size)),
        lambda cell: F.struct(level.alias("level"), cell.alias("cell")),
    )


def _floor(position: Column, size: Column) -> Column:
    return ((position - F.pmod(position, size)) / size).cast("long")


def listed(
    intervals: DataFrame, keys: Sequence[str], first: Column, last: Column, occupied: DataFrame
) -> DataFrame:
    """Intervals once for each block from ``first`` to ``last`` that can hold a point, as ``_block``.

    Intervals that touch up to SHORT blocks are listed at each of them. A longer one becomes at most
    RADIX + 1 cells, and is listed only at the blocks of ``occupied`` (keys, _block) inside it: what
    an interval without an end costs depends on the points of its key alone.
    """
    spans = intervals.withColumn("_first", first).withColumn("_last", last)
    short = F.col("_last") - F.col("_first") < SHORT
    near = spans.where(short).withColumn("_block", F.explode(F.sequence("_first", "_last")))
    far = spans.where(~short).withColumn("_cell", F.explode(_cells(F.col("_first"), F.col("_last"))))
    # Points cannot see an interval at the lowest level: it would be short.
    places = occupied.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_block").alias("_place"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("level"), _floor(F.col("_block"), F.lit(RADIX**n)).alias("cell"))
                    for n in range(1, LEVELS)
                ]
            )
        ).alias("_seen"),
    )
    inside = (F.col("_cell") == F.col("_seen")) & F.col("_place").between(F.col("_first"), F.col("_last"))
    for k in keys:
        inside = inside & (F.col(k) == F.col(f"_o_{k}"))
    met = far.join(places, inside).withColumn("_block", F.col("_place"))
    columns = [*intervals.columns, "_block"]
    return near.select(*columns).unionByName(met.select(*columns))


def point_in_interval(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    t: str,
    start: str,
    end: str,
    bounds: str = "[)",
    on_extra: Column | None = None,
    how: str = "left",
    width: int = DAY,
) -> DataFrame:
    """Attach every interval of the key that contains the point.

    ``bounds`` is one of "[)", "[]", "(]", "()". ``on_extra`` filters the interval side inside the
    join condition, so left points survive it. Both sides meet by equality on (keys, block of
    ``width``), where intervals are ``listed``; the exact limits are tested on those matches only.
    How the sides are joined is left to their measured sizes.
    """
    keys = list(keys)
    iv = intervals if on_extra is None else intervals.where(on_extra)
    iv = iv.where(F.col(start) <= F.col(end))
    known = points.where(F.col(t).isNotNull())
    occupied = known.select(*keys, block(micros(t), width).alias("_block")).distinct()
    rows = listed(iv, keys, block(micros(start), width), block(micros(end), width), occupied)
    iv = rows.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    after = F.col(t) >= F.col(start) if bounds[0] == "[" else F.col(t) > F.col(start)
    before = F.col(t) <= F.col(end) if bounds[1] == "]" else F.col(t) < F.col(end)
    condition = (F.col("_point_block") == F.col("_block")) & after & before
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_k_{k}"))
    joined = points.withColumn("_point_block", block(micros(t), width)).join(iv, condition, how)
    return joined.drop("_point_block", "_block", *[f"_k_{k}" for k in keys])


def window_join(
    events: DataFrame,
    scores: DataFrame,
    key: str,
    event_t: str,
    score_t: str,
    before_hours: int,
    after_hours: int,
) -> DataFrame:
    """Inner pairs with score_t inside [event_t - before, event_t + after].

    The result holds every pair by definition; where only the first is wanted use
    ``bands.first_in_band``, which never builds them.
    """
    spans = (
        events.withColumn("_from", shift(event_t, hours=-before_hours))
        .withColumn("_to", shift(event_t, hours=after_hours))
    )
    return point_in_interval(
        scores, spans, [key], score_t, "_from", "_to", "[]", how="inner"
    ).drop("_from", "_to")


def bounded_join(
    points: DataFrame, stays: DataFrame, key: str, t: str, start: str, end: str, months: int
) -> DataFrame:
    """Inner join of points strictly inside an interval widened by calendar months."""
    wide = stays.withColumn("_from", shift_months(start, -months)).withColumn(
        "_to", shift_months(end, months)
    )
    inside = (F.col(t) > F.col("_from")) & (F.col(t) < F.col("_to"))
    return points.join(wide, key, "inner").where(inside).drop("_from", "_to")


def backfill_first(
    firsts: DataFrame, bounds: DataFrame, key: str, t: str, bound: str
) -> DataFrame:
    """The first row of each key where the key's bound lies before it."""
    return firsts.join(bounds, key, "inner").where(F.col(bound) < F.col(t))
