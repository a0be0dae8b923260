"""Hourly grids and what is attached to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.time import block, ceil_hour, elapsed, index, shift, trunc
from vitalgrid.operators.chunks import with_halo


def hour_grid(df: DataFrame, key: str, first: str, last: str, lead: int = 24) -> DataFrame:
    """One row per clock hour from ``lead`` hours before the first time to the last.

    Row ``hr`` ends at ceil(first) + hr hours and stands for (end - 1h, end]. A key without times
    has no rows. Keys are spread before they grow: the table of bounds is small, its grid is not.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = hour_runs(df, key, first, last, lead)
    return grown(runs.repartition(parts, key, "_block")).select(key, "hr", "endtime")


def hour_runs(
    df: DataFrame, key: str, first: str, last: str, lead: int = 24, width: int = 240, reach: int = 0
) -> DataFrame:
    """``hour_grid`` before it grows: a run of hours for each key and block of ``width`` clock hours.

    ``grown`` makes the hours of it. A run begins up to ``reach`` hours before its block, so it holds
    what ``with_halo`` copies into the block of rows that reach so far.
    """
    bounds = df.where(F.col(last) >= F.col(first)).select(
        key, ceil_hour(first).alias("_origin"), elapsed("hour", first, last).cast("int").alias("_elapsed")
    )
    at = bounds.withColumn("_hour", index("_origin", "hour"))
    begin, end = F.col("_hour") - lead, F.col("_hour") + F.col("_elapsed")
    blocks = F.sequence(block(begin, width), block(end, width))
    here = F.col("_block") * width - F.col("_hour")
    return at.withColumn("_block", F.explode(blocks)).select(
        key,
        "_block",
        "_origin",
        F.greatest(F.lit(-lead), (here - reach).cast("int")).alias("_first"),
        F.least(F.col("_elapsed"), (here + width - 1).cast("int")).alias("_last"),
    )


def as_runs(grid: DataFrame, key: str, width: int, reach: int) -> DataFrame:
    """Rows of an hourly grid as runs of one hour each, like those of ``hour_runs``."""
    placed = with_halo(grid, index("endtime", "hour"), width, reach)
    origin = F.col("endtime") - F.make_dt_interval(F.lit(0), F.col("hr"))
    return placed.select(
        key, "_block", origin.alias("_origin"), F.col("hr").alias("_first"), F.col("hr").alias("_last")
    )


def grown(runs: DataFrame) -> DataFrame:
    """The hours of runs, as ``hr`` and ``endtime``; rows that are no runs stay as they are, without ``hr``."""
    hours = F.when(F.col("_first").isNotNull(), F.sequence("_first", "_last"))
    rows = runs.withColumn("hr", F.explode_outer(hours))
    end = F.col("_origin") + F.make_dt_interval(F.lit(0), F.col("hr"))
    known = [F.col("endtime")] if "endtime" in runs.columns else []
    return rows.withColumn("endtime", F.coalesce(*known, end)).drop("_origin", "_first", "_last")


def bucket_agg(
    grid: DataFrame,
    events: DataFrame,
    key: str,
    t: str,
    aggregates: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Aggregate events into the grid hour that contains them, keeping empty hours.

    Grid ends are whole hours, so an event belongs to exactly the hour ending at ceil(t). Events
    are reduced to one row per hour first and met by an equality join; no range join remains.
    ``aggregates`` maps an output name to (function, column).
    """
    functions = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    reduced = (
        events.where(F.col(t).isNotNull())
        .groupBy(F.col(key), ceil_hour(t).alias("endtime"))
        .agg(*[functions[f](c).alias(name) for name, (f, c) in aggregates.items()])
    )
    return grid.join(reduced, [key, "endtime"], "left")


def bucket_agg_range_join(
    grid: DataFrame, events: DataFrame, key: str, t: str, aggregates: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """``bucket_agg`` written as the range join it replaces: the comparison form for tests and bench."""
    functions = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    e = events.withColumnRenamed(key, "_key")
    inside = (
        (F.col(key) == F.col("_key"))
        & (F.col(t) > shift("endtime", hours=-1))
        & (F.col(t) <= F.col("endtime"))
    )
    return (
        grid.join(e, inside, "left")
        .groupBy(key, "hr", "endtime")
        .agg(*[functions[f](c).alias(name) for name, (f, c) in aggregates.items()])
    )


def interval_to_hours(
    intervals: DataFrame, start: str, end: str, out: str = "endtime"
) -> DataFrame:
    """One row per whole hour h with start < h <= end."""
    first = shift(trunc("hour", start), hours=1)
    last = trunc("hour", end)
    return intervals.where(first <= last).withColumn(
        out, F.explode(F.sequence(first, last, F.expr("interval 1 hour")))
    )


def interval_at_bucket_end(
    grid: DataFrame,
    intervals: DataFrame,
    key: str,
    start: str,
    end: str,
    aggregates: Sequence[Column],
) -> DataFrame:
    """Sample intervals at every grid end; hours covered by none stay empty.

    An interval is sampled from the first to the last hour of its key's grid at most, so one without
    a real end costs no more than the grid.
    """
    reach = grid.groupBy(F.col(key).alias("_key")).agg(
        F.min("endtime").alias("_first"), F.max("endtime").alias("_last")
    )
    within = clipped(
        intervals.join(reach, F.col(key) == F.col("_key")).drop("_key"), start, end, "_first", "_last"
    )
    sampled = interval_to_hours(within, start, end).groupBy(key, "endtime").agg(*aggregates)
    return grid.join(sampled, [key, "endtime"], "left")


def clipped(intervals: DataFrame, start: str, end: str, first: str, last: str) -> DataFrame:
    """Intervals cut to what they share with the hours from ``first`` to ``last``, the others dropped.

    The start stays below ``first``, as an hour counts if it lies behind the start.
    """
    inside = (F.col(end) >= F.col(first)) & (F.col(start) < F.col(last))
    return (
        intervals.where(inside)
        .withColumn(start, F.greatest(F.col(start), shift(first, hours=-1)))
        .withColumn(end, F.least(F.col(end), F.col(last)))
        .drop(first, last)
    )
