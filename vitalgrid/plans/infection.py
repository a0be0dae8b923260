"""Antibiotic orders and the cultures taken around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.rules import exclude, matches_any, positive_flag
from vitalgrid.functions.time import ntz
from vitalgrid.operators.bands import first_in_band, first_match, hours_after, hours_before
from vitalgrid.operators.intervals import point_in_interval
from vitalgrid.operators.ranking import surrogate_id
from vitalgrid.operators.relational import distinct_rows, semi_pair
from vitalgrid.plans import items


def antibiotic(t) -> DataFrame:
    """Antibiotic orders, one row per order and containing stay (NULL stay when there is none).

    An order qualifies by its (drug, route) pair. The pair must occur on some order of another
    type than the excluded ones; which order that is does not matter.
    """
    orders = t["prescriptions"]
    pairs = exclude(
        orders.where(matches_any("drug", items.ANTIBIOTIC_PATTERNS)),
        "drug_type",
        items.EXCLUDED_DRUG_TYPES,
    )
    pairs = exclude(pairs, "route", items.EXCLUDED_ROUTES, items.EXCLUDED_ROUTE_PARTS)
    pairs = exclude(pairs, "drug", substrings=items.EXCLUDED_DRUG_PARTS)
    kept = semi_pair(orders, distinct_rows(pairs, ["drug", "route"]), ["drug", "route"])
    stays = t["icustays"].select("hadm_id", "stay_id", "intime", "outtime")
    placed = point_in_interval(
        kept.select("subject_id", "hadm_id", "drug", "route", "starttime", "stoptime"),
        stays,
        ["hadm_id"],
        "starttime",
        "intime",
        "outtime",
        "[)",
    )
    return placed.select(
        "subject_id",
        "hadm_id",
        "stay_id",
        F.col("drug").alias("antibiotic"),
        "route",
        "starttime",
        "stoptime",
    )


def cultures(t) -> DataFrame:
    """One row per specimen: when, what, and whether an organism other than the negative grew."""
    grown = positive_flag("org_name", "org_itemid", items.NEGATIVE_CULTURE)
    return (
        t["microbiologyevents"]
        .groupBy("micro_specimen_id")
        .agg(
            F.max("subject_id").alias("subject_id"),
            F.max("chartdate").cast("date").alias("chartdate"),
            F.max("charttime").alias("charttime"),
            F.max("spec_type_desc").alias("specimen"),
            F.max(grown).alias("positive"),
        )
    )


def suspicion_of_infection(t) -> DataFrame:
    """One row per antibiotic order: the first culture of the 72 h before or the 24 h after it."""
    numbered = surrogate_id(
        t["antibiotic"],
        ["subject_id"],
        "starttime",
        ties=["stoptime", "antibiotic", "route", "stay_id", "hadm_id"],
        out="ab_id",
    ).withColumnRenamed("starttime", "antibiotic_time")
    orders = t.keep("numbered_orders", numbered)
    culture_time = F.coalesce(F.col("charttime"), ntz("chartdate")).alias("culture_time")
    rank = F.struct(
        F.col("chartdate").isNull().alias("undated"),
        "chartdate",
        F.col("charttime").isNull().alias("untimed"),
        "charttime",
        "micro_specimen_id",
        "specimen",
        "positive",
        culture_time,
    )
    matches = first_in_band(
        orders,
        cultures(t),
        ["subject_id"],
        "antibiotic_time",
        {"before": hours_before(72), "after": hours_after(24)},
        rank,
        "charttime",
        right_date="chartdate",
        date_bands={"before": (-3, 0), "after": (0, 1)},
        width=t.width(orders, ["subject_id"], "antibiotic_time"),
    )
    found = first_match(orders, matches, ["subject_id", "antibiotic_time"])
    specimen = F.coalesce(F.col("before.specimen"), F.col("after.specimen"))
    return found.select(
        "subject_id",
        "stay_id",
        "hadm_id",
        "ab_id",
        "antibiotic",
        "antibiotic_time",
        F.when(specimen.isNull(), 0).otherwise(1).alias("suspected_infection"),
        F.when(
            specimen.isNotNull(),
            F.coalesce(F.col("before.culture_time"), F.col("antibiotic_time")),
        ).alias("suspected_infection_time"),
        F.coalesce(F.col("before.culture_time"), F.col("after.culture_time")).alias(
            "culture_time"
        ),
        specimen.alias("specimen"),
        F.coalesce(F.col("before.positive"), F.col("after.positive")).alias("positive_culture"),
    )
