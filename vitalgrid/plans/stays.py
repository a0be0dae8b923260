"""Stay times, the hourly grid and weight intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.time import shift
from vitalgrid.operators import ranking
from vitalgrid.operators.aggregates import time_bounds
from vitalgrid.operators.grid import hour_grid, hour_runs
from vitalgrid.operators.intervals import backfill_first
from vitalgrid.operators.relational import join_inner, join_left, union_rows
from vitalgrid.plans import items


def icustay_times(t) -> DataFrame:
    """One row per stay: first and last heart-rate time, NULL where none was charted."""
    beats = t.readings("chartevents", [items.HEART_RATE])
    bounds = time_bounds(beats, ["stay_id"], "charttime", "intime_hr", "outtime_hr")
    stays = t["icustays"].select("subject_id", "hadm_id", "stay_id")
    return join_left(stays, bounds, "stay_id").select(
        "subject_id", "hadm_id", "stay_id", "intime_hr", "outtime_hr"
    )


def icustay_hourly(t, width: int | None = None, reach: int = 0) -> DataFrame:
    """One row per stay and hour, from 24 hours before the first heart rate to the last.

    With ``width``, its runs by blocks of so many hours, which have not grown yet.
    """
    bounds = (t["icustay_times"], "stay_id", "intime_hr", "outtime_hr")
    return hour_grid(*bounds, lead=24) if width is None else hour_runs(*bounds, 24, width, reach)


def weight_durations(t) -> DataFrame:
    """Validity intervals of charted weights, with the time before the first one filled."""
    charted = (
        t.readings("chartevents", [items.WEIGHT_ADMIT, items.WEIGHT_DAILY])
        .where(F.col("valuenum") > 0)
        .select(
            "stay_id",
            "charttime",
            F.col("valuenum").alias("weight"),
            F.when(F.col("itemid") == items.WEIGHT_ADMIT, "admit")
            .otherwise("daily")
            .alias("weight_type"),
        )
    )
    numbered = ranking.ordinal_within(
        charted, ["stay_id", "weight_type"], "charttime", ties=["weight"]
    )
    stays = t["icustays"].select("stay_id", "intime", "outtime")
    first_admit = (F.col("weight_type") == "admit") & (F.col("rn") == 1)
    starts = join_inner(numbered, stays, "stay_id").withColumn(
        "starttime",
        F.when(first_admit, shift("intime", hours=-2)).otherwise(F.col("charttime")),
    )
    starts = t.keep("weight_starts", starts)
    ties = ["weight_type", "weight"]
    closed = ranking.next_start_as_end(
        starts.withColumn("_bound", shift("outtime", hours=2)),
        ["stay_id"],
        "starttime",
        "_bound",
        "endtime",
        ties,
        t.width(starts, ["stay_id"], "starttime"),
    )
    out = ["stay_id", "starttime", "endtime", "weight", "weight_type"]
    by = [F.col(c).asc_nulls_last() for c in ("starttime", *ties)]
    firsts = ranking.top1(starts.select("stay_id", "starttime", *ties), ["stay_id"], by)
    gaps = backfill_first(firsts, stays, "stay_id", "starttime", "intime").select(
        "stay_id",
        shift("intime", hours=-2).alias("starttime"),
        F.col("starttime").alias("endtime"),
        "weight",
        "weight_type",
    )
    return union_rows(closed.select(*out), gaps)
