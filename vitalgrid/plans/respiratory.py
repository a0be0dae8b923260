"""Ventilation status and its intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.rules import classify
from vitalgrid.operators.relational import join_left, union_keys
from vitalgrid.operators.sessions import collapse_sessions, gap_change_sessions
from vitalgrid.plans import items


def ventilation_status(device, mode, hamilton):
    """The first category that applies; NULL for settings in none of them."""

    def among(column, values):
        return F.coalesce(column.isin(list(values)), F.lit(False))

    return classify(
        [
            (among(device, items.TRACH_DEVICES), "Tracheostomy"),
            (
                among(device, items.INVASIVE_DEVICES)
                | among(mode, items.INVASIVE_MODES)
                | among(hamilton, items.INVASIVE_MODES_HAMILTON),
                "InvasiveVent",
            ),
            (
                among(device, items.NONINVASIVE_DEVICES)
                | among(hamilton, items.NONINVASIVE_MODES_HAMILTON),
                "NonInvasiveVent",
            ),
            (among(device, items.HIGH_FLOW_DEVICES), "HFNC"),
            (among(device, items.SUPPLEMENTAL_DEVICES), "SupplementalOxygen"),
            (among(device, items.NO_DEVICE), "None"),
        ]
    )


def ventilation(t) -> DataFrame:
    """One row per stay and episode of one ventilation status."""
    at = ["stay_id", "charttime"]
    settings = t["ventilator_setting"].select(*at, "ventilator_mode", "ventilator_mode_hamilton")
    oxygen = t["oxygen_delivery"].select(*at, "o2_delivery_device_1")
    times = union_keys([settings, oxygen], at)
    states = join_left(join_left(times, settings, at), oxygen, at).select(
        *at,
        ventilation_status(
            F.col("o2_delivery_device_1"),
            F.col("ventilator_mode"),
            F.col("ventilator_mode_hamilton"),
        ).alias("ventilation_status"),
    )
    known = t.keep("ventilation_states", states.where(F.col("ventilation_status").isNotNull()))
    sessions = gap_change_sessions(
        known, "stay_id", "charttime", "ventilation_status", items.VENT_GAP_HOURS,
        width=t.width(known, ["stay_id"], "charttime"),
    )
    status = F.max("ventilation_status").alias("ventilation_status")
    return collapse_sessions(
        sessions, "stay_id", "session", "charttime", "next_t", items.VENT_GAP_HOURS, [status]
    ).select("stay_id", "starttime", "endtime", "ventilation_status")
