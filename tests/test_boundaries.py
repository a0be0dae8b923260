"""Hand-written rows at the limits of every rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from vitalgrid.functions import cleaning, rules
from vitalgrid.functions.time import ceil_hour, elapsed
from vitalgrid.operators.bands import hours_before
from vitalgrid.operators.grid import bucket_agg, hour_grid, interval_to_hours
from vitalgrid.plans import items, scores
from vitalgrid.plans.graph import Tables, build_order
from vitalgrid.plans.respiratory import ventilation_status

CHART = (
    "subject_id long, stay_id long, charttime timestamp_ntz, storetime timestamp_ntz, "
    "itemid int, value string, valuenum double"
)
LABS = (
    "specimen_id long, subject_id long, hadm_id long, charttime timestamp_ntz, "
    "storetime timestamp_ntz, itemid int, value string, valuenum double"
)
STAYS = (
    "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz"
)
ORDERS = (
    "subject_id long, hadm_id long, starttime timestamp_ntz, stoptime timestamp_ntz, "
    "drug string, route string, drug_type string"
)
CULTURES = (
    "micro_specimen_id long, subject_id long, chartdate date, charttime timestamp_ntz, "
    "spec_type_desc string, org_name string, org_itemid int"
)
STAY = (1, 10, 100, at("08:00"), at("5 08:00"))


def chart(*events):
    """(time, item, text or number[, stored])"""
    out = []
    for e in events:
        t, item, v = e[:3]
        number = float(v) if isinstance(v, (int, float)) else None
        out.append((1, 100, at(t), at(e[3] if len(e) > 3 else t), item, str(v), number))
    return out


def one_value(spark, column, schema, *values):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "unit, a, b, want",
    [
        ("hour", "11:00", "12:59", 1),
        ("hour", "11:59", "12:01", 1),
        ("hour", "23:59", "2 00:00", 1),
        ("hour", "12:01", "11:59", -1),
        ("minute", "11:59:59", "12:00:00", 1),
        ("minute", "12:00:00", "12:00:59", 0),
    ],
)
def test_elapsed(spark, unit, a, b, want):
    got = one_value(
        spark, elapsed(unit, "a", "b"), "a timestamp_ntz, b timestamp_ntz", (at(a), at(b))
    )
    assert got == [want]


def test_elapsed_missing_side(spark):
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one_value(spark, elapsed("hour", "a", "b"), schema, (at("11:00"), None)) == [None]


def test_ceil_hour(spark):
    got = one_value(
        spark, ceil_hour("t"), "t timestamp_ntz", at("10:00"), at("10:00:01"), at("23:30")
    )
    assert got == [at("10:00"), at("11:00"), at("2 00:00")]


def test_grid_and_bucket_limits(spark):
    stays = spark.createDataFrame(
        [(1, at("10:00"), at("12:10")), (2, at("10:00:01"), at("10:00:01")), (3, None, None)],
        "k long, a timestamp_ntz, b timestamp_ntz",
    )
    grid = hour_grid(stays, "k", "a", "b")
    assert grid.where("k = 1").count() == 27 and grid.where("k = 3").count() == 0
    assert rows(grid.where("hr = 0"), "k", "endtime") == [(1, at("10:00")), (2, at("11:00"))]
    events = spark.createDataFrame(
        [(1, at("11:00"), 1), (1, at("11:00:01"), 2), (1, at("12:00"), 3)],
        "k long, t timestamp_ntz, v int",
    )
    got = bucket_agg(grid, events, "k", "t", {"hi": ("max", "v"), "lo": ("min", "v")})
    assert rows(got.where("hi is not null"), "hr", "lo", "hi") == [(1, 1, 1), (2, 2, 3)]


def test_interval_hours(spark):
    df = spark.createDataFrame(
        [(1, at("10:00"), at("12:00")), (2, at("10:10"), at("10:50")), (3, at("10:59"), at("11:00"))],
        "k long, s timestamp_ntz, e timestamp_ntz",
    )
    assert rows(interval_to_hours(df, "s", "e", "h"), "k", "h") == [
        (1, at("11:00")),
        (1, at("12:00")),
        (3, at("11:00")),
    ]


FIO2_CASES = (0.2, 0.21, 1.0, 1.5, 19.9, 20.0, 20.1, 100.0, 101.0)
FIO2_WANT = {
    "lab": [None, 21.0, 100.0, None, None, None, 20.1, 100.0, None],
    "chart": [None, 21.0, 100.0, None, None, 20.0, 20.1, 100.0, None],
    "ventilator": [20.0, 21.0, 100.0, None, None, 20.0, 20.1, 100.0, None],
}


@pytest.mark.parametrize("rule", list(FIO2_WANT))
def test_fio2_rules(spark, rule):
    got = one_value(spark, cleaning.fio2_percent("v", rule), "v double", *FIO2_CASES)
    assert got == pytest.approx(FIO2_WANT[rule])


def test_bounds(spark):
    bound = {1: cleaning.Bound(0, 10), 2: cleaning.Bound(0, 10, ("low", "high"))}
    values = [(i, v) for i in (1, 2, 3) for v in (0.0, 0.1, 10.0, 10.1, None)]
    got = one_value(spark, cleaning.bounded("v", "i", bound), "i int, v double", *values)
    assert got == [None, 0.1, None, None, None, 0.0, 0.1, 10.0, None, None, 0.0, 0.1, 10.0, 10.1, None]


def test_dose_and_volume(spark):
    schema = "r double, u string, w double"
    cases = [(0.1, "mg/kg/min", 1.0), (0.1, "mg/kg/min", 70.0), (0.1, "mg/kg/min", None),
             (0.1, "mcg/kg/min", 70.0), (0.1, None, 70.0)]
    assert one_value(spark, cleaning.dose_mcg("r", "u", "w"), schema, *cases) == [
        0.1, 100.0, 100.0, 0.1, 0.1,
    ]
    got = one_value(
        spark, cleaning.signed_volume("v", "i", [9]), "v double, i int", (5.0, 9), (-5.0, 9), (5.0, 1)
    )
    assert got == [-5.0, -5.0, 5.0]


def test_pattern_list(spark):
    names = ["CefePIME 2g", "Ala-Tet", "saline", "bicillin l-a", "Septra DS", "", None]
    got = one_value(
        spark, rules.matches_any("d", items.ANTIBIOTIC_PATTERNS), "d string", *names
    )
    assert got == [True, True, False, True, True, False, None]
    assert len(items.ANTIBIOTIC_PATTERNS) == len(set(items.ANTIBIOTIC_PATTERNS)) == 152
    text = spark.createDataFrame([(p,) for p in items.ANTIBIOTIC_PATTERNS], "d string")
    assert text.where(rules.matches_any("d", items.ANTIBIOTIC_PATTERNS)).count() == 152


def test_exclude_drops_missing(spark):
    df = spark.createDataFrame([("IV",), ("OU",), ("left ear",), (None,)], "r string")
    assert rows(rules.exclude(df, "r", ["OU"], ["ear"]), "r") == [("IV",)]


def test_anion_gap_is_exempt(spark):
    labs = spark.createDataFrame(
        [(1, 1, 10, at("10:00"), None, items.ANION_GAP, None, -2.0),
         (1, 1, 10, at("10:00"), None, 50912, None, 0.0),
         (1, 1, 10, at("10:05"), None, 50912, None, 150.0),
         (2, 1, 10, at("10:00"), None, 50912, None, 150.1)], LABS,
    )
    got = rows(Tables({"labevents": labs})["chemistry"], "specimen_id", "aniongap", "creatinine", "charttime")
    assert got == [(1, -2.0, 150.0, at("10:05")), (2, None, None, at("10:00"))]


def test_gcs(spark):
    m, v, e, tube = items.GCS_MOTOR, items.GCS_VERBAL, items.GCS_EYES, items.GCS_INTUBATED
    events = chart(
        ("00:00", m, 5), ("00:00", v, 3), ("00:00", e, 2),
        ("05:59", m, 4),  # carries verbal and eyes
        ("11:59", e, 1),  # exactly six hours later: nothing carried
        ("13:00", v, tube),  # intubated now
        ("14:00", m, 1),  # intubated before
        ("15:00", v, 2),  # previous has no verbal of its own
        ("23:00", v, None),
    )
    df = spark.createDataFrame(
        [(*r[:5], None if r[5] == "None" else r[5], r[6]) for r in events], CHART
    )
    got = {r.charttime: r.gcs for r in Tables({"chartevents": df})["gcs"].collect()}
    assert got == {
        at("00:00"): 10, at("05:59"): 9, at("11:59"): 12, at("13:00"): 15, at("14:00"): 15,
        at("15:00"): 7, at("23:00"): 15,
    }


def weights(spark, *events):
    t = Tables(
        {
            "chartevents": spark.createDataFrame(chart(*events), CHART),
            "icustays": spark.createDataFrame([STAY], STAYS),
        }
    )
    return rows(t["weight_durations"], "starttime", "endtime", "weight", "weight_type")


def test_weights_admit_only(spark):
    assert weights(spark, ("09:00", 226512, 80)) == [
        (at("06:00"), at("5 10:00"), 80.0, "admit")
    ]


def test_weights_daily_only_is_backfilled(spark):
    assert weights(spark, ("20:00", 224639, 70)) == [
        (at("06:00"), at("20:00"), 70.0, "daily"),
        (at("20:00"), at("5 10:00"), 70.0, "daily"),
    ]


def test_weights_both_and_equal_starts(spark):
    got = weights(
        spark, ("09:00", 226512, 80), ("2 09:00", 226512, 81), ("2 09:00", 224639, 79), ("10:00", 224639, 0)
    )
    assert got == [
        (at("06:00"), at("2 09:00"), 80.0, "admit"),
        (at("2 09:00"), at("2 09:00"), 81.0, "admit"),
        (at("2 09:00"), at("5 10:00"), 79.0, "daily"),
    ]


def lab(specimen, t, item, v, text=None):
    return (specimen, 1, 10, at(t), at(t), item, text, v)


def test_bg_lookback_and_equal_times(spark):
    labs = [lab(2, "10:00", 50821, 90.0), lab(1, "10:00", 50821, 80.0), lab(3, "20:00", 50821, 60.0)]
    labs += [lab(1, "10:00", 50818, 40.0), lab(3, "20:00", 50816, 0.5)]
    beside = chart(("06:00", 223835, 40), ("15:59:59", 223835, 50), ("20:00:01", 223835, 60))
    t = Tables(
        {
            "labevents": spark.createDataFrame(labs, LABS),
            "chartevents": spark.createDataFrame(beside, CHART),
        }
    )
    got = rows(t["bg"], "charttime", "po2", "fio2_chartevents", "fio2", "pao2fio2ratio")
    # Exactly four hours back counts, a second more does not; the lower specimen stays.
    assert got == [(at("10:00"), 80.0, 40.0, None, 200.0), (at("20:00"), 60.0, None, 50.0, 120.0)]


def suspicion(spark, ab: str, *cultures):
    t = Tables(
        {
            "prescriptions": spark.createDataFrame(
                [(1, 10, at(ab), None, "Vancomycin", "IV", "MAIN")], ORDERS
            ),
            "icustays": spark.createDataFrame([STAY], STAYS),
            "microbiologyevents": spark.createDataFrame(
                [
                    (i, 1, at(c if " " in c else f"1 {c}").date(), at(c) if timed else None, what, "E. COLI", 1)
                    for i, (c, timed, what) in enumerate(cultures)
                ],
                CULTURES,
            ),
        }
    )
    r = t["suspicion_of_infection"].collect()
    assert len(r) == 1
    return r[0].suspected_infection, r[0].suspected_infection_time, r[0].specimen


def test_culture_limits(spark):
    assert suspicion(spark, "2 10:00", ("2 10:00", True, "B")) == (0, None, None)  # same time
    assert suspicion(spark, "4 10:00", ("1 10:00", True, "B"))[1] == at("1 10:00")  # 72 h
    assert suspicion(spark, "4 10:00:01", ("1 10:00", True, "B"))[0] == 0
    assert suspicion(spark, "2 10:00", ("3 10:00", True, "B"))[1] == at("2 10:00")  # 24 h after
    assert suspicion(spark, "2 10:00", ("3 10:00:01", True, "B"))[0] == 0
    assert suspicion(spark, "4 23:00", ("1 00:00", False, "B"))[1] == at("1 00:00")  # by date
    assert suspicion(spark, "5 00:00", ("1 00:00", False, "B"))[0] == 0
    two = suspicion(spark, "4 10:00", ("3 01:00", True, "LATE"), ("2 01:00", True, "EARLY"))
    assert two == (1, at("2 01:00"), "EARLY")


def test_antibiotic_pairs(spark):
    orders = [
        (1, 10, at("09:00"), None, "Vancomycin", "IV", "MAIN"),
        (1, 10, at("10:00"), None, "Vancomycin", "IV", "BASE"),  # shares a qualifying pair
        (1, 10, at("5 08:00"), None, "Vancomycin", "IV", "MAIN"),  # at out-time: no stay
        (1, 10, at("09:00"), None, "Meropenem", "IV", "BASE"),  # no qualifying order
        (1, 10, at("09:00"), None, "Meropenem", None, "MAIN"),
        (1, 10, at("09:00"), None, "Mupirocin Cream", "PO", "MAIN"),
        (1, 10, at("09:00"), None, "Gentamicin", "LEFT EYE", "MAIN"),
    ]
    t = Tables(
        {
            "prescriptions": spark.createDataFrame(orders, ORDERS),
            "icustays": spark.createDataFrame([STAY, (1, 10, 101, at("08:30"), at("09:30"))], STAYS),
        }
    )
    assert rows(t["antibiotic"], "starttime", "stay_id") == sorted(
        [(at("09:00"), 100), (at("09:00"), 101), (at("10:00"), 100), (at("5 08:00"), None)],
        key=lambda r: (str(r[0]), r[1] is None, str(r[1])),
    )


def test_ventilation_status_labels(spark):
    cases = [
        ("Trach mask ", "CMV", None), ("Trach mask", None, None), (None, "CMV", "NIV"),
        ("Bipap mask ", None, None), (None, None, "NIV-ST"), ("Nasal cannula", None, None),
        ("None", None, None), (None, "Other", None), (None, None, None),
    ]
    got = one_value(
        spark,
        ventilation_status(F.col("d"), F.col("m"), F.col("h")),
        "d string, m string, h string",
        *cases,
    )
    assert got == [
        "Tracheostomy", None, "InvasiveVent", "NonInvasiveVent", "NonInvasiveVent",
        "SupplementalOxygen", "None", None, None,
    ]


def vent(spark, *events):
    df = spark.createDataFrame(
        [(1, 100, at(t), at(t), 223849, mode, None) for t, mode in events], CHART
    )
    t = Tables({"chartevents": df})
    return rows(t["ventilation"], "starttime", "endtime", "ventilation_status")


def test_ventilation_gap(spark):
    # Thirteen clock hours hold a session together, fourteen split it.
    assert vent(spark, ("01:00", "CMV"), ("14:59", "CMV")) == [
        (at("01:00"), at("14:59"), "InvasiveVent")
    ]
    assert vent(spark, ("01:59", "CMV"), ("15:01", "CMV")) == []


def flows(*events):
    """An oxygen flow with a device at each time, so the time has a status."""
    out = []
    for t, device in events:
        out += chart((t, 223834, 2), (t, 226732, device))
    return out


def test_ventilation_changes(spark):
    df = spark.createDataFrame(
        flows(
            ("01:00", "Nasal cannula"), ("02:00", "Nasal cannula"),
            ("03:00", "Endotracheal tube"),  # a single time between changes
            ("04:00", "Nasal cannula"), ("05:00", "Nasal cannula"), ("06:00", "unknown"),
        ), CHART,
    )
    got = rows(Tables({"chartevents": df})["ventilation"], "starttime", "endtime", "ventilation_status")
    assert got == [
        (at("01:00"), at("03:00"), "SupplementalOxygen"),
        (at("04:00"), at("05:00"), "SupplementalOxygen"),
    ]


def test_oxygen_rows(spark):
    df = spark.createDataFrame(
        chart(
            ("01:00", 223834, 2, "01:10"), ("01:00", 227582, 9, "01:20"), ("01:00", 227287, 1),
            ("01:00", 226732, "b"), ("01:00", 226732, "a"), ("01:00", 226732, "e"),
            ("01:00", 226732, "d"), ("01:00", 226732, "c"), ("02:00", 226732, "device only"),
        ), CHART,
    )
    got = rows(
        Tables({"chartevents": df})["oxygen_delivery"], "charttime", "stay_id", "o2_flow",
        "o2_flow_additional", *[f"o2_delivery_device_{i}" for i in range(1, 5)],
    )
    assert got == [(at("01:00"), 100, 9.0, 1.0, "a", "b", "c", "d")]


def test_urine_rate(spark):
    out = "stay_id long, charttime timestamp_ntz, itemid int, value double"
    drops = [("09:00", 100.0), ("14:59", 10.0), ("20:00", 1.0), ("2 08:00", 1000.0), ("2 19:00:01", 5.0)]
    t = Tables(
        {
            "outputevents": spark.createDataFrame([(100, at(x), 226559, v) for x, v in drops], out),
            "chartevents": spark.createDataFrame(
                chart(("08:00", items.HEART_RATE, 80), ("08:00", 226512, 50)), CHART
            ),
            "icustays": spark.createDataFrame([STAY], STAYS),
        }
    )
    got = {r.charttime: r for r in t["urine_output_rate"].collect()}
    assert got[at("14:59")].urineoutput_6hr == 110.0  # five clock hours
    assert got[at("20:00")].urineoutput_6hr == 1.0  # six: out
    assert got[at("20:00")].urineoutput_12hr == 111.0  # eleven clock hours
    assert got[at("2 08:00")].urineoutput_24hr == 1111.0  # exactly 23 hours
    assert got[at("2 19:00:01")].urineoutput_24hr == 1005.0  # a second more
    assert got[at("14:59")].uo_tm_6hr == 6.98
    assert got[at("14:59")].uo_mlkghr_6hr == pytest.approx(110 / 50 / (419 / 60), abs=1e-4)
    assert got[at("09:00")].uo_mlkghr_6hr is None  # one hour of data


POINTS = "{} double".format(" double, ".join(scores.SOFA_VALUES))


def points(spark, organ, **values):
    row = tuple(values.get(c) for c in scores.SOFA_VALUES)
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in row)], POINTS)
    return df.select(scores.organ_points()[organ]).collect()[0][0]


LADDERS = [
    ("respiration", "pao2fio2ratio_vent", [(99.9, 4), (100, 3), (199.9, 3), (200, 2), (299.9, 2), (300, 1), (400, 0)]),
    ("respiration", "pao2fio2ratio_novent", [(50, 2), (300, 1), (399.9, 1), (400, 0)]),
    ("coagulation", "platelet_min", [(19.9, 4), (20, 3), (50, 2), (100, 1), (150, 0)]),
    ("liver", "bilirubin_max", [(12, 4), (11.9, 3), (6, 3), (2, 2), (1.2, 1), (1.1, 0)]),
    ("cns", "gcs_min", [(5, 4), (6, 3), (9, 3), (10, 2), (12, 2), (13, 1), (14, 1), (15, 0)]),
    ("renal", "creatinine_max", [(5, 4), (3.5, 3), (2, 2), (1.2, 1), (1.1, 0)]),
    ("renal", "uo_24hr", [(199.9, 4), (200, 3), (499.9, 3), (500, 0)]),
    ("cardiovascular", "meanbp_min", [(69.9, 1), (70, 0)]),
    ("cardiovascular", "rate_dopamine", [(15.1, 4), (15, 3), (5.1, 3), (5, 2), (0.1, 2), (0, 0)]),
    ("cardiovascular", "rate_dobutamine", [(0.1, 2), (0, 0)]),
    ("cardiovascular", "rate_epinephrine", [(0.11, 4), (0.1, 3), (0, 3)]),
    ("cardiovascular", "rate_norepinephrine", [(0.11, 4), (0.1, 3)]),
]


@pytest.mark.parametrize("organ, column, cases", LADDERS)
def test_ladders(spark, organ, column, cases):
    df = spark.createDataFrame(
        [tuple(float(v) if c == column else None for c in scores.SOFA_VALUES) for v, _ in cases], POINTS
    )
    got = [r[0] for r in df.select(scores.organ_points()[organ]).collect()]
    assert got == [p for _, p in cases]


def test_ladders_missing_and_mixed(spark):
    for organ in scores.ORGANS:
        assert points(spark, organ) is None
    # An unventilated ratio of 68 with a ventilated one of 120 is 3 points, not 4.
    assert points(spark, "respiration", pao2fio2ratio_novent=68, pao2fio2ratio_vent=120) == 3
    assert points(spark, "renal", creatinine_max=3.6, uo_24hr=199) == 4


def test_sofa_window(spark):
    """One bad platelet count counts for 24 rows and reaches admission from before it."""
    beats = chart(("10:00", items.HEART_RATE, 80), ("3 10:00", items.HEART_RATE, 80))
    labs = [lab(1, "09:30", 51265, 10.0), lab(2, "2 12:30", 51265, 120.0)]
    empty_in = "stay_id long, linkorderid long, itemid int, starttime timestamp_ntz, endtime timestamp_ntz, amount double, rate double, rateuom string, patientweight double"
    t = Tables(
        {
            "icustays": spark.createDataFrame([STAY], STAYS),
            "chartevents": spark.createDataFrame(beats, CHART),
            "labevents": spark.createDataFrame(labs, LABS),
            "inputevents": spark.createDataFrame([], empty_in),
            "outputevents": spark.createDataFrame([], "stay_id long, charttime timestamp_ntz, itemid int, value double"),
        }
    )
    got = {r.hr: r for r in t["sofa"].collect()}
    assert min(got) == 0 and max(got) == 48 and len(got) == 49
    assert got[0].coagulation == 4 and got[23].sofa_24hours == 4 and got[24].sofa_24hours == 0
    assert [got[h].sofa_24hours for h in (26, 27, 48)] == [0, 1, 1]
    assert len(t["sofa"].columns) == 29 and "hadm_id" not in t["sofa"].columns


def sepsis(spark, suspicions, high):
    soi = "subject_id long, stay_id long, ab_id int, antibiotic_time timestamp_ntz, culture_time timestamp_ntz, suspected_infection int, suspected_infection_time timestamp_ntz"
    organs = ", ".join(f"{o}_24hours int" for o in scores.ORGANS)
    t = Tables(
        {
            "suspicion_of_infection": spark.createDataFrame(
                [(1, 100, i, at(x), None, 1, at(x)) for i, x in enumerate(suspicions)], soi
            ),
            "sofa": spark.createDataFrame(
                [(100, at(x), total, *([total] + [0] * 5)) for x, total in high],
                f"stay_id long, endtime timestamp_ntz, sofa_24hours int, {organs}",
            ),
        }
    )
    return rows(t["sepsis3"], "suspected_infection_time", "sofa_time", "sofa_score", "sepsis3")


def test_sepsis_window(spark):
    assert sepsis(spark, ["5 10:00"], [("3 10:00", 2)]) == [(at("5 10:00"), at("3 10:00"), 2, True)]
    assert sepsis(spark, ["5 10:00"], [("6 10:00", 3)]) == [(at("5 10:00"), at("6 10:00"), 3, True)]
    assert sepsis(spark, ["5 10:00"], [("3 09:00", 2), ("6 11:00", 2), ("5 10:00", 1)]) == []
    # The earliest suspicion with a score wins; an earlier one without a score does not.
    got = sepsis(spark, ["1 00:00", "9 10:00", "8 10:00"], [("8 09:00", 2), ("8 08:00", 4)])
    assert got == [(at("8 10:00"), at("8 08:00"), 4, True)]


def test_rounding(spark):
    got = one_value(spark, F.round("v", 2), "v double", 1.005, 2.675)
    assert got == [1.01, 2.68]


def test_build_order():
    order = build_order(["sepsis3"])
    assert set(order) >= {"sofa", "suspicion_of_infection", "antibiotic", "bg"}
    assert order.index("icustay_times") < order.index("icustay_hourly") < order.index("sofa")
    assert order[-1] == "sepsis3"
    assert hours_before(72)[1] == 0


def test_derived_tables_fill_every_measure(spark):
    """A column that no reading reaches would agree with any oracle."""
    from vitalgrid.plans import charted, labs
    from vitalgrid.plans.graph import Tables
    from vitalgrid.sources.derived import bronze

    tables = Tables(bronze(spark.read.parquet("/root/testdata/sf0.001/events.parquet")))
    plans = (labs.bg, labs.chemistry, labs.enzyme, labs.complete_blood_count, charted.vitalsign, charted.ventilator_setting)
    for plan in plans:
        df = plan(tables)
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
        assert not [c for c, n in filled.items() if not n], plan.__name__
