"""Raw clinical tables derived from the ``events`` log.

The public test tables hold no clinical data. These functions turn every event into clinical
records by fixed arithmetic on its id, so all models run on data of any size and the same tables
can be stated in SQL (``catalog.bronze_sql``) for checking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.time import shift

# (itemid, lowest value, number of values, step)
CHART_ITEMS = (
    (220045, 60, 80, 1.0), (220179, 80, 90, 1.0), (220180, 40, 60, 1.0), (220181, 50, 60, 1.0),
    (220052, 45, 70, 1.0), (220210, 8, 30, 1.0), (223761, 95, 10, 1.0), (220277, 85, 20, 1.0),
    (220621, 60, 300, 1.0), (223901, 1, 6, 1.0), (223900, 1, 5, 1.0), (220739, 1, 4, 1.0),
    (226512, 50, 60, 1.0), (224639, 48, 64, 1.0), (223835, 15, 60, 2.0), (220339, -1, 120, 1.0),
    (223834, 1, 15, 1.0), (227582, 1, 15, 1.0), (227287, 1, 10, 1.0), (226732, 0, 1, 1.0),
    (223849, 0, 1, 1.0), (229314, 0, 1, 1.0), (224690, 8, 30, 1.0),
    (220050, 385, 30, 1.0), (225309, -2, 90, 1.0), (220051, 285, 30, 1.0), (225310, -2, 60, 1.0),
    (225312, 285, 30, 1.0), (223762, 8, 45, 1.0), (224642, 0, 5, 1.0), (225664, -2, 60, 1.0),
    (226537, 60, 60, 1.0), (224688, 8, 20, 1.0), (224689, 0, 20, 1.0), (224687, 3, 12, 1.0),
    (224684, 35, 20, 10.0), (224685, 30, 25, 10.0), (224686, 25, 30, 10.0), (224696, 10, 30, 1.0),
    (224700, -2, 105, 1.0), (224691, 20, 60, 1.0), (223848, 0, 4, 1.0),
)
LAB_ITEMS = (
    (52033, 0, 1, 1.0), (50821, 40, 120, 1.0), (50818, 20, 60, 1.0), (50816, 1, 100, 1.0),
    (50820, 7, 1, 1.0), (50912, 1, 70, 0.1), (50885, 1, 160, 0.1), (51265, 5, 400, 1.0),
    (50868, -3, 30, 1.0), (50813, 1, 20, 1.0), (51301, 1, 40, 1.0),
    (50801, 5, 90, 1.0), (50802, -15, 30, 1.0), (50803, 10, 30, 1.0), (50804, 12, 30, 1.0),
    (50805, 0, 10, 1.0), (50806, 90, 30, 1.0), (50808, 1, 20, 0.1), (50809, 1, 12, 1000.0),
    (50810, 20, 84, 1.0), (50811, 5, 15, 1.0), (50814, 0, 5, 1.0), (50815, 1, 15, 1.0),
    (50817, 60, 44, 1.0), (50819, 0, 20, 1.0), (50822, 2, 6, 1.0), (50823, 20, 80, 1.0),
    (50824, 120, 40, 1.0), (50825, 34, 8, 1.0), (50862, 1, 12, 1.0), (50930, 1, 12, 1.0),
    (50976, 1, 22, 1.0), (50882, 1, 12, 1000.0), (51006, 5, 300, 1.0), (50893, 1, 12, 1000.0),
    (50902, 1, 12, 1000.0), (50931, 1, 12, 1000.0), (50983, 120, 85, 1.0), (50971, 1, 34, 1.0),
    (50861, -2, 90, 1.0), (50863, -2, 90, 1.0), (50878, -2, 90, 1.0), (50867, -2, 90, 1.0),
    (50883, -2, 20, 1.0), (50884, -2, 20, 1.0), (50910, -2, 90, 1.0), (50911, -2, 90, 1.0),
    (50927, -2, 90, 1.0), (50954, -2, 90, 1.0), (51221, -2, 60, 1.0), (51222, -2, 20, 1.0),
    (51248, -2, 40, 1.0), (51249, -2, 40, 1.0), (51250, -2, 99, 1.0), (51279, -2, 9, 1.0),
    (51277, -2, 25, 1.0), (52159, -2, 60, 1.0),
)
DEVICES = (
    "Endotracheal tube", "Nasal cannula", "Trach mask ", "High flow nasal cannula", "Bipap mask ",
    "None",
)
MODES = ("CMV/ASSIST", "SIMV", "Other")
HAMILTON_MODES = ("NIV", "ASV")
DRUGS = (
    "Vancomycin", "Piperacillin-Tazobactam", "Heparin", "Mupirocin Cream",
    "Gentamicin Ophth Oint", "CefePIME", "Clindamycin Gel", "Meropenem",
)
ROUTES = ("IV", "PO", "OU", "RIGHT EAR", None)


def event_id() -> Column:
    return F.col("event_id")


def _pick(values: Sequence[str | None], by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def _ids() -> list[Column]:
    user = F.col("user_id")
    return [
        (F.lit(30000000) + user).alias("stay_id"),
        (F.lit(20000000) + user).alias("hadm_id"),
        (F.lit(10000000) + F.floor(user / 2)).cast("long").alias("subject_id"),
    ]


def _items(table: Sequence[tuple]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("itemid"),
                F.lit(lo).alias("lo"),
                F.lit(span).alias("span"),
                F.lit(step).alias("step"),
            )
            for i, lo, span, step in table
        ]
    )


def _with_items(events: DataFrame, items: Column) -> DataFrame:
    return events.withColumn("_i", F.explode(items)).select("*", "_i.*").drop("_i")


def icustays(events: DataFrame) -> DataFrame:
    return (
        events.select(*_ids(), "ts")
        .groupBy("stay_id", "hadm_id", "subject_id")
        .agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"))
    )


def chartevents(events: DataFrame) -> DataFrame:
    item = F.col("itemid")
    # An event charts the items whose code makes event_id + itemid divisible by three.
    thirds = [_items([i for i in CHART_ITEMS if (r + i[0]) % 3 == 0]) for r in range(3)]
    charted = F.when(event_id() % 3 == 0, thirds[0]).when(event_id() % 3 == 1, thirds[1])
    rows = _with_items(
        events.select(*_ids(), "event_id", "ts"), charted.otherwise(thirds[2])
    )
    reading = F.col("lo") + (event_id() * 31 + item * 17) % F.col("span")
    textual = item.isin(226732, 223849, 229314)
    value = (
        F.when(item == 226732, _pick(DEVICES, event_id()))
        .when(item == 223849, _pick(MODES, event_id()))
        .when(item == 229314, _pick(HAMILTON_MODES, event_id()))
        .when((item == 223900) & (event_id() % 9 == 0), "No Response-ETT")
        .otherwise(reading.cast("string"))
    )
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), item % 5, F.lit(0))
    stored = F.make_dt_interval(F.lit(0), F.lit(0), (10 + event_id() % 3).cast("int"), F.lit(0))
    return rows.select(
        "stay_id",
        "hadm_id",
        "subject_id",
        (F.col("ts") + minutes).alias("charttime"),
        (F.col("ts") + stored).alias("storetime"),
        "itemid",
        value.alias("value"),
        F.when(~textual, (reading * F.col("step")).cast("double")).alias("valuenum"),
    )


def labevents(events: DataFrame) -> DataFrame:
    item = F.col("itemid")
    # Events of even id give a blood gas, the others the remaining panels.
    gases, others = ([i for i in LAB_ITEMS if (i[0] < 50850 or i[0] == 52033) is kind] for kind in (True, False))
    panel = F.when(event_id() % 2 == 0, _items(gases)).otherwise(_items(others))
    rows = _with_items(events.select(*_ids(), "event_id", "ts"), panel)
    reading = F.col("lo") + (event_id() * 13 + item * 7) % F.col("span")
    gas = (item < 50850) | (item == 52033)
    kind = item == 52033
    return rows.select(
        "stay_id",
        "hadm_id",
        "subject_id",
        (event_id() * 10 + F.when(gas, 0).otherwise(1)).alias("specimen_id"),
        "itemid",
        shift("ts", minutes=3).alias("charttime"),
        shift("ts", minutes=20).alias("storetime"),
        F.when(kind, F.when(event_id() % 4 == 0, "ART.").otherwise("VEN.")).alias("value"),
        F.when(~kind, (reading * F.col("step")).cast("double")).alias("valuenum"),
    )


def inputevents(events: DataFrame) -> DataFrame:
    hours = F.make_dt_interval(F.lit(0), (2 + event_id() % 9).cast("int"))
    item = F.element_at(
        F.array(*[F.lit(i) for i in (221289, 221906, 221662, 221653)]),
        (event_id() % 4 + 1).cast("int"),
    )
    fine = (event_id() % 200).cast("double") / 1000
    return events.where(F.col("event_type") == "purchase").select(
        *_ids(),
        event_id().alias("linkorderid"),
        item.alias("itemid"),
        F.col("ts").alias("starttime"),
        (F.col("ts") + hours).alias("endtime"),
        (event_id() % 97).cast("double").alias("amount"),
        F.when(event_id() % 4 < 2, fine).otherwise((event_id() % 25).cast("double")).alias("rate"),
        F.when(event_id() % 25 == 1, "mg/kg/min").otherwise("mcg/kg/min").alias("rateuom"),
        F.when(event_id() % 50 == 1, 1.0).otherwise(70.0).alias("patientweight"),
    )


def outputevents(events: DataFrame) -> DataFrame:
    item = F.element_at(
        F.array(*[F.lit(i) for i in (226559, 226560, 227488, 227489)]),
        (event_id() % 4 + 1).cast("int"),
    )
    return events.where(F.col("event_type").isin("view", "error")).select(
        *_ids(),
        F.col("ts").alias("charttime"),
        item.alias("itemid"),
        (20 + event_id() % 400).cast("double").alias("value"),
    )


def prescriptions(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "click").select(
        *_ids(),
        F.col("ts").alias("starttime"),
        shift("ts", days=2).alias("stoptime"),
        _pick(DRUGS, event_id()).alias("drug"),
        _pick(ROUTES, event_id()).alias("route"),
        F.when(event_id() % 7 == 0, "BASE").otherwise("MAIN").alias("drug_type"),
    )


def microbiologyevents(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "error").select(
        *_ids(),
        event_id().alias("micro_specimen_id"),
        F.col("ts").cast("date").alias("chartdate"),
        F.when(event_id() % 5 != 0, F.col("ts")).alias("charttime"),
        F.when(event_id() % 11 != 0, F.when(event_id() % 2 == 0, "BLOOD CULTURE").otherwise("URINE")).alias(
            "spec_type_desc"
        ),
        F.when(event_id() % 3 == 1, "E. COLI").when(event_id() % 3 == 2, "").alias("org_name"),
        F.when(event_id() % 4 == 0, 90856).otherwise(80002).alias("org_itemid"),
    )


BUILDERS = {
    "icustays": icustays,
    "chartevents": chartevents,
    "labevents": labevents,
    "inputevents": inputevents,
    "outputevents": outputevents,
    "prescriptions": prescriptions,
    "microbiologyevents": microbiologyevents,
}


def bronze(events: DataFrame) -> dict[str, DataFrame]:
    """All derived tables. ``events`` needs event_id, ts, user_id and event_type."""
    return {name: build(events) for name, build in BUILDERS.items()}
