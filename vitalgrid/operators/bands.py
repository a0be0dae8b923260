"""First match inside a time band, without building the matching pairs.

The axis is cut into days. A band that is at least a day long covers the end of its first day,
whole days, and the start of its last day. Per (key, day) the smallest candidate is known for the
whole day, for every suffix and for every prefix from running minima; so each band is answered by
one probe per day it touches. Work is linear in rows, bounded per task by one day of one key.

Where a day of a key can be too much, candidates are numbered per key in time order instead (in
blocks of equal depth), a band becomes a range of numbers, and the range is put together from cells
of RADIX ** level numbers whose minima are known: a few equality probes per band, no window at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY, HOUR, block, micros
from vitalgrid.operators import chunks

RADIX = 16
LEVELS = 12  # cells of RADIX ** 11 numbers cover any key


def first_in_band(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_t: str,
    bands: Mapping[str, tuple[int, int]],
    rank: Column,
    right_t: str,
    right_date: str | None = None,
    date_bands: Mapping[str, tuple[int, int]] | None = None,
    width: int | None = DAY,
    unique: bool = False,
) -> DataFrame:
    """For each distinct (keys, left_t): the smallest ``rank`` struct among right rows in each band.

    ``bands`` maps an output column to microsecond offsets (lo, hi): right_t must lie in
    [left_t + lo, left_t + hi), and hi - lo must be at least a day. A right row without a time
    matches by its date instead: date(left_t) + the band's day offsets (first, last), inclusive.
    Returns keys, left_t and one struct column per band, NULL where nothing matches. ``width`` is
    None for blocks of equal depth instead of days. Right rows that are ``unique`` on (keys, right_t)
    are not reduced first, which saves a shuffle of them.
    """
    keys = list(keys)
    date_bands = date_bands or {}
    if any(hi - lo < DAY for lo, hi in bands.values()):
        raise ValueError("a band must span at least one day")

    # Candidates, one per (key, position) before anything is ordered.
    position = micros(right_t)
    day = block(position, DAY)
    if right_date is not None:
        day = F.coalesce(day, block(micros(right_date), DAY))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    at_place = [*keys, day.alias("_day"), position.alias("_pos")]
    usable = right.where(day.isNotNull() & known)
    reduced = usable.select(*at_place, rank.alias("_rank")) if unique else usable.groupBy(*at_place).agg(F.min(rank).alias("_rank"))
    candidates = reduced.select(
        *keys,
        "_day",
        "_pos",
        F.when(F.col("_pos").isNotNull(), F.col("_rank")).alias("_timed"),
        F.when(F.col("_pos").isNull(), F.col("_rank")).alias("_dated"),
    )

    points = left.where(F.col(left_t).isNotNull()).select(*keys, left_t).distinct()
    at = micros(left_t)
    if width is None:
        return _first_by_number(points, candidates, keys, left_t, bands, date_bands)

    # Probes: one per day a band touches.
    probes = []
    for name, (lo, hi) in bands.items():
        first, last = block(at + lo, DAY), block(at + hi, DAY)
        days = F.sequence(first, last)
        dated = F.lit(False)
        if name in date_bands:
            d_lo, d_hi = date_bands[name]
            here = block(at, DAY)
            days = F.array_distinct(
                F.concat(days, F.sequence(here + F.lit(d_lo), here + F.lit(d_hi)))
            )
            dated = F.col("_day").between(here + d_lo, here + d_hi)
        probes.append(
            points.withColumn("_day", F.explode(days)).select(
                *keys,
                left_t,
                "_day",
                F.lit(name).alias("_band"),
                dated.alias("_use_dated"),
                F.when(F.col("_day") == first, "suffix")
                .when(F.col("_day") == last, "prefix")
                .when(F.col("_day").between(first, last), "whole")
                .alias("_mode"),
                F.when(F.col("_day") == first, at + lo)
                .when(F.col("_day") == last, at + hi)
                .otherwise(F.lit(0))
                .alias("_pos"),
            )
        )
    both = reduce(DataFrame.unionByName, probes).unionByName(
        candidates, allowMissingColumns=True
    )

    day_of_key = Window.partitionBy(*keys, "_day")
    is_candidate = F.col("_band").isNull()
    running = (Window.unboundedPreceding, Window.currentRow)
    # A prefix excludes, a suffix includes, candidates at the probe's own position.
    up = day_of_key.orderBy(F.col("_pos").asc_nulls_last(), is_candidate).rowsBetween(*running)
    down = day_of_key.orderBy(
        F.col("_pos").desc_nulls_last(), (~is_candidate).cast("int")
    ).rowsBetween(*running)
    answered = (
        both.withColumn("_prefix", F.min("_timed").over(up))
        .withColumn("_suffix", F.min("_timed").over(down))
        .withColumn("_whole", F.min("_timed").over(day_of_key))
        .withColumn("_date", F.min("_dated").over(day_of_key))
        .where(~is_candidate)
        .select(
            *keys,
            left_t,
            "_band",
            F.when(F.col("_mode") == "prefix", F.col("_prefix"))
            .when(F.col("_mode") == "suffix", F.col("_suffix"))
            .when(F.col("_mode") == "whole", F.col("_whole"))
            .alias("_by_time"),
            F.when(F.col("_use_dated"), F.col("_date")).alias("_by_date"),
        )
    )
    return answered.groupBy(*keys, left_t).agg(
        *[
            F.min(
                F.when(
                    F.col("_band") == name,
                    F.array_min(F.array("_by_time", "_by_date")),
                )
            ).alias(name)
            for name in bands
        ]
    )


def _cell_of(number: Column) -> Column:
    """The (level, cell) of every level that a number lies in."""
    return F.array(
        *[
            F.struct(F.lit(n).alias("level"), F.floor(number / F.lit(RADIX**n)).cast("long").alias("cell"))
            for n in range(LEVELS)
        ]
    )


def _cells_between(begin: Column, end: Column) -> Column:
    """The fewest (level, cell) that make up the numbers from ``begin`` up to, not including, ``end``."""
    parts = []
    for n in range(LEVELS):
        lows = [F.ceil(begin / F.lit(RADIX**m)).cast("long") for m in (n, n + 1)]
        highs = [F.floor(end / F.lit(RADIX**m)).cast("long") for m in (n, n + 1)]

        def run(a: Column, b: Column, level: int = n) -> Column:
            none = F.array().cast("array<struct<level:int,cell:bigint>>")
            cells = F.transform(
                F.sequence(a, F.greatest(a, b - 1)), lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell"))
            )
            return F.when(a < b, cells).otherwise(none)

        # What the next level cannot cover: all of a short run, both fringes of a long one.
        above = lows[1] < highs[1]
        parts.append(run(lows[0], F.when(above, lows[1] * RADIX).otherwise(highs[0])))
        parts.append(run(F.when(above, highs[1] * RADIX).otherwise(highs[0]), highs[0]))
    return F.concat(*parts)


def _first_by_number(
    points: DataFrame,
    candidates: DataFrame,
    keys: list[str],
    left_t: str,
    bands: Mapping[str, tuple[int, int]],
    date_bands: Mapping[str, tuple[int, int]],
) -> DataFrame:
    timed = candidates.where(F.col("_pos").isNotNull()).select(*keys, "_pos", F.col("_timed").alias("_rank"))
    at = micros(left_t)
    asked = points.select(
        *keys,
        left_t,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("band"), (at + lo - 1).alias("before"), (at + hi - 1).alias("upto"))
                    for name, (lo, hi) in bands.items()
                ]
            )
        ).alias("_ask"),
    ).select(*keys, left_t, "_ask.*")
    # How many candidates lie at or before each position anyone asks for.
    positions = (
        timed.select(*keys, "_pos", F.lit(1).alias("_n"))
        .unionByName(asked.select(*keys, F.explode(F.array("before", "upto")).alias("_pos"), F.lit(0).alias("_n")))
        .groupBy(*keys, "_pos")
        .agg(F.sum("_n").alias("_n"))
    )
    numbered = chunks.running_number(positions, keys, "_pos", "_n", "_number")
    cells = (
        timed.join(numbered, [*keys, "_pos"])
        .select(*keys, "_rank", F.explode(_cell_of(F.col("_number"))).alias("_c"))
        .groupBy(*keys, "_c")
        .agg(F.min("_rank").alias("_rank"))
    )
    ranges = asked.join(numbered.withColumnsRenamed({"_pos": "before", "_number": "_begin"}), [*keys, "before"]).join(
        numbered.withColumnsRenamed({"_pos": "upto", "_number": "_end"}), [*keys, "upto"]
    )
    probes = ranges.where("_end > _begin").select(
        *keys, left_t, "band", F.explode(_cells_between(F.col("_begin") + 1, F.col("_end") + 1)).alias("_c")
    )
    found = probes.join(cells, [*keys, "_c"]).select(*keys, left_t, "band", "_rank")
    if date_bands:
        here = block(at, DAY)
        days = [
            points.select(
                *keys, left_t, F.lit(name).alias("band"), F.explode(F.sequence(here + first, here + last)).alias("_day")
            )
            for name, (first, last) in date_bands.items()
        ]
        asked_days = reduce(DataFrame.unionByName, days)
        dated = candidates.where(F.col("_dated").isNotNull()).select(*keys, "_day", F.col("_dated").alias("_rank"))
        found = found.unionByName(asked_days.join(dated, [*keys, "_day"]).select(*keys, left_t, "band", "_rank"))
    best = [F.min(F.when(F.col("band") == name, F.col("_rank"))).alias(name) for name in bands]
    # Points without any match keep a row.
    return points.join(found.groupBy(*keys, left_t).agg(*best), [*keys, left_t], "left")


def hours_before(hours: int) -> tuple[int, int]:
    """Right time in [left - hours, left): the left row follows within the given hours."""
    return -hours * HOUR, 0


def hours_after(hours: int) -> tuple[int, int]:
    """Right time in (left, left + hours]."""
    return 1, hours * HOUR + 1


def around(before: int, after: int) -> tuple[int, int]:
    """Right time in [left - before, left + after] hours."""
    return -before * HOUR, after * HOUR + 1


def first_match(left: DataFrame, matches: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach first matches to every left row, unmatched rows kept."""
    return left.join(matches, list(on), "left")
