"""Cohorts and the small summaries reports are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.time import elapsed


def sepsis_cohort(sepsis: DataFrame, times: DataFrame) -> DataFrame:
    """One row per stay with sepsis and the hours between its first and last heart rate."""
    los = times.select(
        "stay_id", elapsed("hour", "intime_hr", "outtime_hr").alias("icu_los_hours"), "intime_hr"
    )
    return sepsis.join(los, "stay_id", "inner")


def attrition(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left and lost after each ordered filter, from one pass over the table."""
    kept, sums = F.lit(True), [F.count(F.lit(1)).alias("_0")]
    for i, (_, condition) in enumerate(steps, 1):
        kept = kept & F.coalesce(condition, F.lit(False))
        sums.append(F.coalesce(F.sum(kept.cast("long")), F.lit(0)).alias(f"_{i}"))
    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("reason"),
            F.col(f"_{i}").alias("n_left"),
            (F.col(f"_{i - 1}") - F.col(f"_{i}") if i else F.lit(0).cast("long")).alias("n_lost"),
        )
        for i, (name, _) in enumerate([("all", None), *steps])
    ]
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def suppress_small(df: DataFrame, n: str, k: int = 5) -> DataFrame:
    """Hide counts below ``k``."""
    return df.withColumn(n, F.when(F.col(n) >= k, F.col(n)))


def incidence(stays: DataFrame, cases: DataFrame, key: str, by: Sequence[Column]) -> DataFrame:
    """Stays, cases and their share per group."""
    flagged = stays.join(
        cases.select(key).distinct().withColumn("_case", F.lit(1)), key, "left"
    )
    return (
        flagged.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_stays"), F.count("_case").alias("n_cases"))
        .withColumn("share", F.col("n_cases") / F.col("n_stays"))
    )


def trajectory(scores: DataFrame, hour: str, score: str, hours: int = 24) -> DataFrame:
    """Stays and score total per block of hours since admission."""
    block = F.floor(F.col(hour) / hours).cast("int").alias("block")
    return scores.groupBy(block).agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.sum(score).cast("long").alias("score_total"),
        F.max(score).alias("score_max"),
    )


def alert_delay(cases: DataFrame, start: str, alert: str) -> DataFrame:
    """Clock hours from admission to alert: cases per day of delay."""
    delay = elapsed("hour", start, alert)
    return cases.groupBy(F.floor(delay / 24).cast("int").alias("delay_days")).agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.min(delay).alias("shortest_hours"),
        F.max(delay).alias("longest_hours"),
    )


def text_cohort(
    notes: DataFrame, text: str, people: DataFrame, key: str, term: str
) -> DataFrame:
    """People with a note that contains a term, whatever its case."""
    hits = notes.where(F.lower(F.col(text)).contains(term.lower())).select(key)
    return people.join(hits.distinct(), key, "left_semi")


def seeded_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A sample that is the same for the same data layout and seed."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """A sample by a hash of the keys: the same rows whatever the layout, all rows of a key or none."""
    if fraction >= 1:
        return df
    limit = format(round(max(fraction, 0) * 2**32), "08x")
    return df.where(F.md5(F.concat_ws(":", F.lit(str(seed)), *keys)) < limit)
