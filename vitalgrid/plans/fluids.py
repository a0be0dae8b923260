"""Urine output, its hourly rate, and vasopressor infusions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.cleaning import dose_mcg, filter_items, signed_volume
from vitalgrid.functions.time import elapsed
from vitalgrid.operators.aggregates import sum_by, time_bounds
from vitalgrid.operators.intervals import bounded_join, point_in_interval
from vitalgrid.operators.ranking import lag_or
from vitalgrid.operators.relational import join_inner
from vitalgrid.operators.rolling import trailing_sums
from vitalgrid.plans import items


def urine_output(t) -> DataFrame:
    """One row per stay and time: net urine volume, irrigation fluid subtracted."""
    rows = filter_items(t["outputevents"], "itemid", items.URINE_ITEMS).withColumn(
        "urineoutput", signed_volume("value", "itemid", [items.IRRIGANT_IN])
    )
    return sum_by(rows, ["stay_id", "charttime"], "urineoutput")


def urine_output_rate(t) -> DataFrame:
    """One row per stay and time: trailing volumes, hours they cover and mL/kg/h."""
    beats = t.readings("chartevents", [items.HEART_RATE])
    stays = t["icustays"].select("stay_id", "intime", "outtime")
    near = bounded_join(
        beats.select("stay_id", "charttime"), stays, "stay_id", "charttime", "intime", "outtime", 1
    )
    bounds = time_bounds(near, ["stay_id"], "charttime", "intime_hr", "outtime_hr")
    measured = t.keep(
        "urine_measured", join_inner(t["urine_output"], bounds.drop("outtime_hr"), "stay_id")
    )
    width = t.width(measured, ["stay_id"], "charttime")
    since = lag_or(measured, ["stay_id"], "charttime", "intime_hr", "_before", width=width).select(
        "stay_id",
        "charttime",
        F.col("urineoutput").alias("uo"),
        elapsed("minute", "_before", "charttime").alias("minutes"),
    )
    sums = trailing_sums(
        since,
        "stay_id",
        "charttime",
        {"urineoutput": "uo", "minutes": "minutes"},
        {"_6hr": 5, "_12hr": 11},
        "_24hr",
        rows=t.rows(measured),
    )
    for h in ("6hr", "12hr", "24hr"):
        sums = sums.withColumn(f"_hours_{h}", F.col(f"minutes_{h}") / F.lit(60.0))
    weights = t["weight_durations"].select("stay_id", "starttime", "endtime", "weight")
    weighed = point_in_interval(
        sums,
        weights,
        ["stay_id"],
        "charttime",
        "starttime",
        "endtime",
        "(]",
        on_extra=F.col("weight") > 0,
    )

    def rate(h: str, least: int):
        volume, hours = F.col(f"urineoutput_{h}"), F.col(f"_hours_{h}")
        per_kilo = F.try_divide(volume.cast("double"), F.col("weight"))
        return F.when(hours >= least, F.round(per_kilo / hours, 4)).alias(f"uo_mlkghr_{h}")

    return weighed.select(
        "stay_id",
        "charttime",
        "weight",
        "uo",
        "urineoutput_6hr",
        "urineoutput_12hr",
        "urineoutput_24hr",
        rate("6hr", 6),
        rate("12hr", 12),
        rate("24hr", 24),
        *[F.round(f"_hours_{h}", 2).alias(f"uo_tm_{h}") for h in ("6hr", "12hr", "24hr")],
    )


def _infusion(t, item: int, rate="rate") -> DataFrame:
    rows = filter_items(t["inputevents"], "itemid", [item])
    return rows.select(
        "stay_id",
        "linkorderid",
        (F.col(rate) if isinstance(rate, str) else rate).alias("vaso_rate"),
        F.col("amount").alias("vaso_amount"),
        "starttime",
        "endtime",
    )


def epinephrine(t) -> DataFrame:
    """One row per infusion record."""
    return _infusion(t, items.EPINEPHRINE)


def norepinephrine(t) -> DataFrame:
    """One row per infusion record, rates in micrograms."""
    return _infusion(t, items.NOREPINEPHRINE, dose_mcg("rate", "rateuom", "patientweight"))


def dopamine(t) -> DataFrame:
    """One row per infusion record."""
    return _infusion(t, items.DOPAMINE)


def dobutamine(t) -> DataFrame:
    """One row per infusion record."""
    return _infusion(t, items.DOBUTAMINE)
