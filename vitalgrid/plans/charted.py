"""Wide tables from bedside charting: vitals, ventilator settings, oxygen, coma scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.cleaning import merge_codes, require
from vitalgrid.functions.time import HOUR
from vitalgrid.operators.lookback import prev_within
from vitalgrid.operators.pivot import codes_of, pivot_columns, pivot_items
from vitalgrid.operators.ranking import top_per_group
from vitalgrid.plans import items


def _vitals(columns: tuple[str, ...] | None) -> list:
    return [m for m in items.VITALS if columns is None or m.name in columns]


def vital_codes(columns: tuple[str, ...] | None = None) -> list[int]:
    """Items that feed the vitals, or the named ones of them."""
    codes = codes_of(_vitals(columns))
    if columns is None or "temperature" in columns:
        codes += [*items.TEMPERATURE_F, *items.TEMPERATURE_C]
    return codes


def vitalsign(t, columns: tuple[str, ...] | None = None) -> DataFrame:
    """One row per subject, stay and time: averaged vitals inside their plausible ranges.

    With ``columns``, only those are built and only their items are read.
    """
    spec, extra = _vitals(columns), []
    if columns is None or "temperature" in columns:
        extra = [items.temperature_celsius()]
    rows = require(t.readings("chartevents", vital_codes(columns)), ["stay_id"])
    return rows.groupBy("subject_id", "stay_id", "charttime").agg(
        *pivot_columns(spec, "avg", "itemid", "valuenum"), *extra
    )


def ventilator_setting(t) -> DataFrame:
    """One row per subject and time: ventilator settings and modes."""
    rows = require(t.readings("chartevents", codes_of(items.VENTILATOR_SETTINGS)), ["value", "stay_id"])
    return pivot_items(
        rows,
        ["subject_id", "charttime"],
        items.VENTILATOR_SETTINGS,
        extra=[F.max("stay_id").alias("stay_id")],
    )


def oxygen_delivery(t) -> DataFrame:
    """One row per subject and time with an oxygen flow: latest flows and up to four devices.

    Times with a device but no flow are absent by definition of the table.
    """
    flows = require(t.readings("chartevents", items.O2_FLOW_ITEMS), ["value"]).select(
        "subject_id",
        "stay_id",
        "charttime",
        merge_codes("itemid", items.O2_FLOW).alias("flow_item"),
        "valuenum",
        # Latest storage time wins; larger values break ties.
        F.struct("storetime", "valuenum", "value").alias("age"),
    )
    latest = flows.groupBy("subject_id", "charttime", "flow_item").agg(
        F.max_by(F.struct("valuenum", "stay_id"), "age").alias("flow")
    )
    device_rows = require(t.readings("chartevents", [items.O2_DEVICE]), ["subject_id", "charttime"])
    devices = top_per_group(
        device_rows,
        ["subject_id", "charttime"],
        [F.col("value").asc_nulls_last(), F.col("stay_id").asc_nulls_last()],
        4,
        "device_no",
    ).select("subject_id", "charttime", "device_no", F.col("value").alias("device"), "stay_id")
    # The stay comes from the flow rows; where one of them lacks it, from the devices as well.
    device_stays = device_rows.groupBy("subject_id", "charttime").agg(
        F.max("stay_id").alias("any_device_stay")
    )

    stacked = (
        latest.select(
            "subject_id",
            "charttime",
            "flow_item",
            F.col("flow.valuenum").alias("flow_value"),
            F.col("flow.stay_id").alias("flow_stay"),
        )
        .unionByName(devices.drop("stay_id"), allowMissingColumns=True)
        .unionByName(device_stays, allowMissingColumns=True)
    )

    def flow(code: int):
        return F.max(F.when(F.col("flow_item") == code, F.col("flow_value")))

    stayless = F.max(F.col("flow_item").isNotNull() & F.col("flow_stay").isNull())
    return (
        stacked.groupBy("subject_id", "charttime")
        .agg(
            F.greatest(
                F.max("flow_stay"), F.when(stayless, F.max("any_device_stay"))
            ).alias("stay_id"),
            flow(items.O2_FLOW_MAIN).alias("o2_flow"),
            flow(items.O2_FLOW_ADDITIONAL).alias("o2_flow_additional"),
            *[
                F.max(F.when(F.col("device_no") == i, F.col("device"))).alias(
                    f"o2_delivery_device_{i}"
                )
                for i in range(1, 5)
            ],
            F.count("flow_item").alias("_flows"),
        )
        .where(F.col("_flows") > 0)
        .drop("_flows")
    )


def gcs(t) -> DataFrame:
    """One row per subject, stay and time: coma scale with six-hour carry-forward of components."""
    rows = t.readings("chartevents", [items.GCS_MOTOR, items.GCS_VERBAL, items.GCS_EYES])

    def component(code: int, value):
        return F.max(F.when(F.col("itemid") == code, value))

    tube = (F.col("itemid") == items.GCS_VERBAL) & (F.col("value") == items.GCS_INTUBATED)
    base = rows.groupBy("subject_id", "stay_id", "charttime").agg(
        component(items.GCS_MOTOR, F.col("valuenum")).alias("motor"),
        component(
            items.GCS_VERBAL, F.when(tube, F.lit(0.0)).otherwise(F.col("valuenum"))
        ).alias("verbal"),
        component(items.GCS_EYES, F.col("valuenum")).alias("eyes"),
        F.max(F.when(tube, 1).otherwise(0)).alias("gcs_unable"),
    )
    parts = ["motor", "verbal", "eyes"]
    seen = prev_within(base, "stay_id", "charttime", parts, 6 * HOUR, ties=["subject_id"])
    normal = {"motor": 6, "verbal": 5, "eyes": 4}

    def total(*sources: str):
        known = [
            F.coalesce(*[F.col(s + p) for s in sources], F.lit(normal[p])) for p in parts
        ]
        return known[0] + known[1] + known[2]

    now_tube = F.coalesce(F.col("verbal"), F.col("prev_verbal")) == 0
    score = (
        F.when(now_tube, F.lit(15.0))
        .when(F.col("prev_verbal") == 0, total(""))
        .otherwise(total("", "prev_"))
    )
    return seen.select(
        "subject_id",
        "stay_id",
        "charttime",
        score.alias("gcs"),
        *[F.coalesce(F.col(p), F.col("prev_" + p)).alias("gcs_" + p) for p in parts],
        "gcs_unable",
    )
