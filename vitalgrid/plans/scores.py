"""Hourly organ-failure scores and sepsis onset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.rules import score_ladder
from vitalgrid.functions.time import block, ceil_hour, index, shift
from vitalgrid.operators.bands import around, first_in_band
from vitalgrid.operators.chunks import with_halo
from vitalgrid.operators.grid import clipped, grown, interval_to_hours
from vitalgrid.operators.intervals import point_in_interval
from vitalgrid.operators.ranking import top1
from vitalgrid.operators.relational import join_inner, star_merge
from vitalgrid.operators.rolling import TASK_ROWS, rolling_max_rows
from vitalgrid.plans import items

ORGANS = ["respiration", "coagulation", "liver", "cardiovascular", "cns", "renal"]
AT = ["stay_id", "endtime"]
WINDOW = 24  # rows of the hourly grid that a score looks back over, its own included
BLOCK = 240  # hours of a stay that are worked on together
BEFORE, AFTER = 48, 24  # hours around a suspicion in which a score counts
VITALS_READ = ("mbp",)


def _below(value: str, steps: Sequence[tuple[float, int]]) -> list[tuple[Column, int]]:
    return [(F.col(value) < limit, points) for limit, points in steps]


def _from(value: str, steps: Sequence[tuple[float, int]]) -> list[tuple[Column, int]]:
    return [(F.col(value) >= limit, points) for limit, points in steps]


def _all_null(*names: str) -> Column:
    return F.coalesce(*[F.col(n) for n in names]).isNull()


def organ_points() -> dict[str, Column]:
    """Points 0 to 4 per organ from one hour's values; NULL where nothing was measured."""
    vent, novent = "pao2fio2ratio_vent", "pao2fio2ratio_novent"
    breathing = _below(vent, items.RESPIRATION_VENT) + _below(novent, items.RESPIRATION_NOVENT)
    breathing.sort(key=lambda step: -step[1])
    epi, nor = F.col("rate_epinephrine"), F.col("rate_norepinephrine")
    dopa, dobu = F.col("rate_dopamine"), F.col("rate_dobutamine")
    renal = _from("creatinine_max", items.CREATININE) + _below("uo_24hr", items.URINE_24H)
    renal.sort(key=lambda step: -step[1])
    gcs = F.col("gcs_min")
    return {
        "respiration": score_ladder(breathing, _all_null(vent, novent)),
        "coagulation": score_ladder(
            _below("platelet_min", items.COAGULATION), _all_null("platelet_min")
        ),
        "liver": score_ladder(_from("bilirubin_max", items.LIVER), _all_null("bilirubin_max")),
        "cardiovascular": score_ladder(
            [
                ((dopa > 15) | (epi > 0.1) | (nor > 0.1), 4),
                ((dopa > 5) | (epi <= 0.1) | (nor <= 0.1), 3),
                ((dopa > 0) | (dobu > 0), 2),
                (F.col("meanbp_min") < items.MAP_LOW, 1),
            ],
            _all_null(
                "meanbp_min",
                "rate_dopamine",
                "rate_dobutamine",
                "rate_epinephrine",
                "rate_norepinephrine",
            ),
        ),
        "cns": score_ladder(
            [(gcs.between(low, high), points) for low, high, points in items.CNS]
            + [(gcs < items.CNS_DEEP, 4)],
            _all_null("gcs_min"),
        ),
        "renal": score_ladder(renal, _all_null("uo_24hr", "creatinine_max")),
    }


def _by_hour(df: DataFrame, **values: Column | str) -> DataFrame:
    """Feature rows keyed by the grid hour that contains them; not reduced here."""
    columns = [
        (F.col(v) if isinstance(v, str) else v).alias(name) for name, v in values.items()
    ]
    return df.where(F.col("charttime").isNotNull()).select(
        "stay_id", ceil_hour("charttime").alias("endtime"), *columns
    )


def arterial_ratios(t, grid_bounds: DataFrame) -> DataFrame:
    """Oxygenation per stay and arterial sample, split by invasive ventilation at that time.

    A sample belongs to every stay of its subject; only stays whose grid covers it are kept.
    """
    samples = t["bg"].where(
        (F.col("specimen") == items.ARTERIAL) & F.col("pao2fio2ratio").isNotNull()
    )
    per_stay = point_in_interval(
        samples.select("subject_id", "charttime", "pao2fio2ratio"),
        grid_bounds,
        ["subject_id"],
        "charttime",
        "_from",
        "_to",
        "(]",
        how="inner",
    )
    invasive = t["ventilation"].select(
        "stay_id", "starttime", "endtime", "ventilation_status"
    )
    ventilated = point_in_interval(
        per_stay.select("stay_id", "charttime", "pao2fio2ratio"),
        invasive,
        ["stay_id"],
        "charttime",
        "starttime",
        "endtime",
        "[]",
        on_extra=F.col("ventilation_status") == "InvasiveVent",
    )
    on_vent = F.col("ventilation_status").isNotNull()
    return ventilated.select(
        "stay_id",
        "charttime",
        F.when(~on_vent, F.col("pao2fio2ratio")).alias("novent"),
        F.when(on_vent, F.col("pao2fio2ratio")).alias("vent"),
    )


def hourly_features(t) -> DataFrame:
    """Every grid hour with the worst value of each measurement inside it, in one shuffle.

    Rows lie in blocks of hours (``_block``), each with the hours before it that its windows see
    (``_own`` tells them apart). The grid grows behind the shuffle, which moves a row for each block.
    """
    stays = t["icustays"].select("subject_id", "hadm_id", "stay_id")
    grid = t.hourly_runs(BLOCK, WINDOW - 1)  # built from the stays, so every row has one
    times = t["icustay_times"].where(F.col("intime_hr").isNotNull())
    # The grid of a stay covers (ceil(first) - 25 h, ceil(first) + elapsed hours].
    grid_bounds = times.select(
        "subject_id",
        "stay_id",
        shift(ceil_hour("intime_hr"), hours=-25).alias("_from"),
        shift(ceil_hour("outtime_hr"), hours=1).alias("_to"),
    )

    def by_admission(panel: str, name: str, value: str):
        rows = t[panel].where(F.col(value).isNotNull()).select("hadm_id", "charttime", value)
        return _by_hour(
            join_inner(rows, stays.select("hadm_id", "stay_id"), "hadm_id"), **{name: value}
        )

    urine = t["urine_output_rate"].where(F.col("uo_tm_24hr").between(22, 30))
    infusions = []
    for drug in ("epinephrine", "norepinephrine", "dopamine", "dobutamine"):
        rows = t[drug].select(
            "stay_id", "starttime", F.col("endtime").alias("_stop"), F.col("vaso_rate")
        )
        # An infusion that was never closed counts to the end of its stay's grid.
        within = clipped(
            join_inner(rows, grid_bounds.drop("subject_id"), "stay_id"), "starttime", "_stop", "_from", "_to"
        )
        infusions.append(
            interval_to_hours(within, "starttime", "_stop").select(
                *AT, F.col("vaso_rate").alias(f"rate_{drug}")
            )
        )
    features = [
        _by_hour(
            arterial_ratios(t, grid_bounds),
            pao2fio2ratio_novent="novent",
            pao2fio2ratio_vent="vent",
        ),
        *infusions,
        _by_hour(t.narrow("vitalsign", VITALS_READ), meanbp_min="mbp"),
        _by_hour(t["gcs"], gcs_min="gcs"),
        _by_hour(
            urine, uo_24hr=F.col("urineoutput_24hr").cast("double") / F.col("uo_tm_24hr") * 24
        ),
        by_admission("enzyme", "bilirubin_max", "bilirubin_total"),
        by_admission("chemistry", "creatinine_max", "creatinine"),
        by_admission("complete_blood_count", "platelet_min", "platelet"),
    ]
    lowest = ["pao2fio2ratio_novent", "pao2fio2ratio_vent", "meanbp_min", "gcs_min", "platelet_min"]
    highest = [
        "rate_epinephrine", "rate_norepinephrine", "rate_dopamine", "rate_dobutamine",
        "uo_24hr", "bilirubin_max", "creatinine_max",
    ]
    worst = [F.min(c).alias(c) for c in lowest] + [F.max(c).alias(c) for c in highest]
    blocks = [with_halo(f, index("endtime", "hour"), BLOCK, WINDOW - 1).drop("_own") for f in features]
    hours = t.hours(grid)
    context = grid.sparkSession
    least = int(context.conf.get("spark.sql.shuffle.partitions"))
    parts = least if hours is None else max(context.sparkContext.defaultParallelism, -(-hours // TASK_ROWS))
    merged = star_merge(
        grid, blocks, ["stay_id", "_block", "endtime"], worst, deal=["stay_id", "_block"], parts=parts, grow=grown
    )
    return merged.withColumn("_own", index("endtime", "hour") >= F.col("_block") * BLOCK)


SOFA_VALUES = (
    "pao2fio2ratio_novent", "pao2fio2ratio_vent", "rate_epinephrine", "rate_norepinephrine",
    "rate_dopamine", "rate_dobutamine", "meanbp_min", "gcs_min", "uo_24hr", "bilirubin_max",
    "creatinine_max", "platelet_min",
)


def sofa(t, blocks: bool = False) -> DataFrame:
    """One row per stay and hour from admission on: organ points, 24-row maxima and their sum.

    With ``blocks``, rows tell the block of hours they are dealt by (``_block``).
    """
    scored = hourly_features(t).select(
        "stay_id",
        "hr",
        shift("endtime", hours=-1).alias("starttime"),
        "endtime",
        *SOFA_VALUES,
        *[points.alias(organ) for organ, points in organ_points().items()],
        "_block",
        "_own",
    )
    rolled = rolling_max_rows(
        scored, "stay_id", "hr", WINDOW, ORGANS, "_24hours", total="sofa_24hours", placed=True
    )
    # Hours before admission feed the window and leave only after it.
    scores = rolled.where(F.col("hr") >= 0)
    return scores if blocks else scores.drop("_block")


def within_reach(scores: DataFrame, suspicions: DataFrame, before: int, after: int) -> DataFrame:
    """Scores that lie so many hours around a suspicion of their stay.

    They meet by (stay, block), as the scores are dealt: only the suspicions move.
    """
    at = F.col("suspected_infection_time")
    spans = suspicions.select(
        F.col("stay_id").alias("_stay"), shift(at, hours=-before).alias("_from"), shift(at, hours=after).alias("_to")
    )
    first, last = (block(index(t, "hour"), BLOCK) for t in ("_from", "_to"))
    spans = spans.withColumn("_in", F.explode(F.sequence(first, last)))
    met = (F.col("stay_id") == F.col("_stay")) & (F.col("_block") == F.col("_in"))
    return scores.join(spans, met & F.col("endtime").between(F.col("_from"), F.col("_to")), "left_semi").drop("_block")


def sepsis3(t) -> DataFrame:
    """One row per stay with sepsis: the first suspicion that has a score of 2 or more around it."""
    high = t.scored_hours(BLOCK).where(F.col("sofa_24hours") >= 2)
    # The match depends on (stay, suspicion time) only, so those are made unique first.
    suspicions = top1(
        t["suspicion_of_infection"].where(
            F.col("stay_id").isNotNull() & (F.col("suspected_infection") == 1)
        ),
        ["stay_id", "suspected_infection_time"],
        [
            F.col(c).asc_nulls_last()
            for c in ("antibiotic_time", "culture_time", "subject_id", "ab_id")
        ],
    ).select(
        "subject_id", "stay_id", "antibiotic_time", "culture_time", "suspected_infection_time"
    )
    score = F.struct(
        "endtime", "sofa_24hours", *[F.col(o + "_24hours").alias(o) for o in ORGANS]
    )
    matches = first_in_band(
        suspicions,
        within_reach(high, suspicions, BEFORE, AFTER),
        ["stay_id"],
        "suspected_infection_time",
        {"score": around(BEFORE, AFTER)},
        score,
        "endtime",
        unique=True,
    ).where(F.col("score").isNotNull())
    found = suspicions.join(matches, ["stay_id", "suspected_infection_time"], "inner")
    first = top1(found, ["stay_id"], [F.col("suspected_infection_time").asc_nulls_last()])
    return first.select(
        "subject_id",
        "stay_id",
        "antibiotic_time",
        "culture_time",
        "suspected_infection_time",
        F.col("score.endtime").alias("sofa_time"),
        F.col("score.sofa_24hours").alias("sofa_score"),
        *[F.col(f"score.{o}").alias(o) for o in ORGANS],
        F.lit(True).alias("sepsis3"),
    )
