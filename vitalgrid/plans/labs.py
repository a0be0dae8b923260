"""Laboratory panels per specimen and blood gases with bedside oxygen readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.cleaning import (
    Bound,
    fio2_percent,
    positive_except,
    require,
)
from vitalgrid.functions.rules import aa_gradient, pf_ratio
from vitalgrid.functions.time import HOUR
from vitalgrid.operators.aggregates import preagg
from vitalgrid.operators.lookback import asof_lookback
from vitalgrid.operators.pivot import codes_of, pivot_items
from vitalgrid.operators.ranking import top1
from vitalgrid.plans import items

_IDS = ("subject_id", "hadm_id", "charttime")


def _panel(t, spec, exempt=()) -> DataFrame:
    rows = require(t.readings("labevents", codes_of(spec)), ["valuenum"]).where(
        positive_except("valuenum", "itemid", exempt)
    )
    ids = [F.max(c).alias(c) for c in _IDS]
    return pivot_items(rows, ["specimen_id"], spec, extra=ids)


def chemistry(t) -> DataFrame:
    """One row per specimen: twelve analytes under their upper limits."""
    return _panel(t, items.CHEMISTRY, exempt=[items.ANION_GAP])


def enzyme(t) -> DataFrame:
    """One row per specimen: eleven enzymes and bilirubins."""
    return _panel(t, items.ENZYMES)


def complete_blood_count(t) -> DataFrame:
    """One row per specimen: ten blood-count values."""
    return _panel(t, items.BLOOD_COUNT)


def bg(t) -> DataFrame:
    """One row per subject and time with an oxygen pressure: blood gas, latest bedside readings."""
    ids = [F.max(c).alias(c) for c in _IDS]
    gas = require(
        pivot_items(
            t.readings("labevents", codes_of(items.BLOOD_GAS)), ["specimen_id"], items.BLOOD_GAS, extra=ids
        ),
        ["po2"],
    )
    # Two specimens drawn at one time give one row; the smaller specimen number is kept.
    gas = top1(gas, ["subject_id", "charttime"], [F.col("specimen_id").asc_nulls_last()])

    def reading(code: int):
        rows = t.readings("chartevents", [code])
        return rows.where(Bound(0, 100, ("high",)).holds(F.col("valuenum")))

    at = ["subject_id", "charttime"]
    fio2 = require(
        preagg(
            reading(items.FIO2_CHARTED),
            at,
            [F.max(fio2_percent("valuenum", "chart")).alias("fio2_chartevents")],
        ),
        ["fio2_chartevents"],
    )
    with_fio2 = asof_lookback(
        gas, fio2, ["subject_id"], "charttime", "charttime", ["fio2_chartevents"], 4 * HOUR
    )
    readings = [F.col("fio2"), F.col("fio2_chartevents")]
    return with_fio2.select(
        "*",
        aa_gradient(F.col("po2"), F.col("pco2"), *readings).alias("aado2_calc"),
        pf_ratio(F.col("po2"), *readings).alias("pao2fio2ratio"),
    ).select(*items.BLOOD_GAS_OUTPUT)


def bg_with_spo2(t) -> DataFrame:
    """``bg`` plus the latest pulse-oximeter average of the two hours before each sample."""
    rows = t.readings("chartevents", [items.SPO2])
    spo2 = preagg(
        rows.where(Bound(0, 100, ("high",)).holds(F.col("valuenum"))),
        ["subject_id", "charttime"],
        [F.avg("valuenum").alias("spo2")],
    )
    return asof_lookback(
        t["bg"], spo2, ["subject_id"], "charttime", "charttime", ["spo2"], 2 * HOUR
    )
