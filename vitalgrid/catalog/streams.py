"""Streaming forms, run over everything available and read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.catalog.models import tables_for
from vitalgrid.catalog.models_sql import model_sql
from vitalgrid.catalog.registry import Source, query
from vitalgrid.session import freed_shuffles, scratch_dir
from vitalgrid.operators.bands import hours_after, hours_before
from vitalgrid.streaming.alert import early_alert, hourly_points, use_rocksdb
from vitalgrid.plans import items
from vitalgrid.plans.scores import ORGANS as SOFA_ORGANS
from vitalgrid.streaming import scores
from vitalgrid.streaming.matching import stream_first_match
from vitalgrid.streaming.tables import checked_against_batch, replay_stream, run_to_table
from vitalgrid.streaming.windows import stream_range_join, windowed, with_event_time

MONEY = "decimal(18,2)"
ORGANS = ["click", "error", "purchase", "view"]


def events_stream(s: Source):
    return replay_stream(s.spark, f"{s.folder}/events.parquet", s["events"].schema)


def ntz_columns(df):
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@query(
    "stream_hourly",
    """
select user_id, window_start, window_start + interval 1 hour as window_end, n,
  cast(total as double) as total
from (select user_id, date_trunc('hour', ts) as window_start, count(*) as n,
    sum(cast(value as decimal(18,2))) as total from events group by all)
where window_start + interval 1 hour <= (select max(ts) - interval 2 hour from events)""",
)
def _(s):
    hours = windowed(
        events_stream(s),
        "ts",
        "1 hour",
        "2 hours",
        ["user_id"],
        [F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(MONEY)).alias("total")],
    )
    closed = run_to_table(hours, scratch_dir(s.spark, "hourly"))
    return ntz_columns(closed.withColumn("total", F.col("total").cast("double")))


@query(
    "stream_early_alert",
    """
with h as (
  select user_id, date_trunc('hour', ts) + interval 1 hour as t,
"""
    + ", ".join(
        f"""max(case when event_type = '{o}' then case when value >= 90 then 4 when value >= 60
  then 3 when value >= 40 then 2 when value >= 20 then 1 else 0 end end) as {o}"""
        for o in ORGANS
    )
    + """ from events group by all
), r as (
  select user_id, t, """
    + " + ".join(f"ifnull(max({o}) over w, 0)" for o in ORGANS)
    + """ as score from h
  where t <= (select max(ts) - interval 2 hour from events)
  window w as (partition by user_id order by t range between interval 23 hour preceding
    and current row)
)
select user_id, min(t) as alert_time, cast(arg_min(score, t) as integer) as score
from r where score >= 7 group by user_id""",
)
def _(s):
    value = F.col("value")
    points = (
        F.when(value >= 90, 4).when(value >= 60, 3).when(value >= 40, 2).when(value >= 20, 1)
    ).otherwise(0)
    scored = events_stream(s).select(
        "user_id", "ts", *[F.when(F.col("event_type") == o, points).alias(o) for o in ORGANS]
    )
    hourly = hourly_points(scored, "user_id", "ts", ORGANS, "2 hours")
    use_rocksdb(s.spark)
    alerts = early_alert(hourly, "user_id", ORGANS, 7)
    return ntz_columns(run_to_table(alerts, scratch_dir(s.spark, "alert")))


@query(
    "stream_range_join",
    """
select p.event_id as purchase_id, e.event_id as error_id
from events p join events e on e.user_id = p.user_id and e.event_type = 'error'
  and p.ts <= e.ts + interval 72 hour and p.ts > e.ts - interval 24 hour
where p.event_type = 'purchase'""",
)
def _(s):
    def side(kind: str, prefix: str):
        rows = events_stream(s).where(F.col("event_type") == kind)
        rows = rows.select(
            F.col("user_id").alias(f"{prefix}_user"),
            F.col("event_id").alias(f"{prefix}_id"),
            F.col("ts").alias(f"{prefix}_ts"),
        )
        return with_event_time(rows, f"{prefix}_ts", "2 hours")

    pairs = stream_range_join(
        side("purchase", "purchase"),
        side("error", "error"),
        "purchase_user",
        "error_user",
        "purchase_ts",
        "error_ts",
        "72 hours",
        "24 hours",
    )
    return run_to_table(
        pairs.select("purchase_id", "error_id"), scratch_dir(s.spark, "pairs")
    )


@query(
    "stream_first_match",
    """
with s as (
  select event_id as id, user_id, cast(ts as date) as day,
    case when event_id % 5 <> 0 then ts end as t from events where event_type = 'signup'
), e as (
  select * from events where event_type = 'error' and ts + interval 24 hour
    < (select max(case when event_type = 'signup' and event_id % 5 = 0
          then cast(cast(ts as date) as timestamp) else ts end)
        from events where event_type in ('signup', 'error')) - interval 26 hour
), pre as (
  select e.event_id, s.id from e join s on s.user_id = e.user_id and case
    when t is not null then t < e.ts and e.ts <= t + interval 72 hour
    else cast(e.ts as date) between day and day + 3 end
  qualify row_number() over (partition by e.event_id order by day, t, id) = 1
), post as (
  select e.event_id, s.id from e join s on s.user_id = e.user_id and case
    when t is not null then t - interval 24 hour <= e.ts and e.ts < t
    else cast(e.ts as date) between day - 1 and day end
  qualify row_number() over (partition by e.event_id order by day, t, id) = 1
)
select e.user_id, e.event_id, pre.id as signup_before, post.id as signup_after
from e left join pre using (event_id) left join post using (event_id)""",
)
def _(s):
    """First match in both bands, reported once when nothing later can match."""
    use_rocksdb(s.spark)
    errors = events_stream(s).where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    signups = events_stream(s).where(F.col("event_type") == "signup").select(
        "user_id",
        F.col("event_id").alias("signup_id"),
        F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("t"),
    )
    found = stream_first_match(
        errors,
        signups,
        "user_id",
        "event_id",
        "ts",
        "signup_id",
        "t",
        {"signup_before": hours_before(72), "signup_after": hours_after(24)},
        "2 hours",
        right_date="day",
        date_bands={"signup_before": (-3, 0), "signup_after": (0, 1)},
    )
    return run_to_table(found, scratch_dir(s.spark, "match"))


DRUGS = ("epinephrine", "norepinephrine", "dopamine", "dobutamine")


def score_streams(s: Source) -> list:
    """The inputs of the score, each stored as a table and replayed as a stream."""
    t = tables_for(s, "sofa")
    folder = scratch_dir(s.spark, "score_inputs")

    def replayed(name: str, rows):
        with freed_shuffles(s.spark):
            rows.write.parquet(f"{folder}/{name}")
        return replay_stream(s.spark, f"{folder}/{name}", rows.schema)

    stays = t["icustays"].select("subject_id", "hadm_id", "stay_id")
    urine = t["urine_output_rate"].where(F.col("uo_tm_24hr").between(22, 30))
    samples = t["bg"].where((F.col("specimen") == items.ARTERIAL) & F.col("pao2fio2ratio").isNotNull())
    tables = {
        "meanbp_min": (t.narrow("vitalsign", ("mbp",)), "mbp"),
        "gcs_min": (t["gcs"], "gcs"),
        "uo_24hr": (
            urine.select("stay_id", "charttime", (F.col("urineoutput_24hr").cast("double") / F.col("uo_tm_24hr") * 24).alias("uo")),
            "uo",
        ),
        "bilirubin_max": (t["enzyme"].join(stays, "hadm_id"), "bilirubin_total"),
        "creatinine_max": (t["chemistry"].join(stays, "hadm_id"), "creatinine"),
        "platelet_min": (t["complete_blood_count"].join(stays, "hadm_id"), "platelet"),
        "pao2fio2ratio": (samples.join(stays.select("subject_id", "stay_id"), "subject_id"), "pao2fio2ratio"),
    }
    streams = [
        scores.readings(replayed(kind, rows.select("stay_id", "charttime", value)), "stay_id", "charttime", kind, value)
        for kind, (rows, value) in tables.items()
    ]
    span = ("stay_id", "starttime", "endtime")
    for drug in DRUGS:
        rows = replayed(drug, t[drug].select(*span, "vaso_rate"))
        streams.append(scores.intervals(rows, *span, f"rate_{drug}", "vaso_rate"))
    aided = t["ventilation"].where("ventilation_status = 'InvasiveVent'").select(*span)
    streams.append(scores.intervals(replayed("ventilated", aided), *span, scores.VENTILATED))
    bounds = t["icustay_times"].select("stay_id", "intime_hr", "outtime_hr")
    streams.append(scores.intervals(replayed("stay", bounds), "stay_id", "intime_hr", "outtime_hr", scores.STAY))
    return streams


SCORE_EVENTS = " union all ".join(
    [
        "select charttime as t from vitalsign where mbp is not null and stay_id is not null",
        "select charttime from gcs where gcs is not null and stay_id is not null",
        "select charttime from urine_output_rate where uo_tm_24hr between 22 and 30",
        *(
            f"select p.charttime from {panel} p join icustays i on i.hadm_id = p.hadm_id where {value} is not null"
            for panel, value in (
                ("enzyme", "bilirubin_total"), ("chemistry", "creatinine"), ("complete_blood_count", "platelet")
            )
        ),
        f"""select b.charttime from bg b join icustays i on i.subject_id = b.subject_id
  where b.specimen = '{items.ARTERIAL}' and b.pao2fio2ratio is not null""",
        *(f"select unnest([starttime, endtime]) from {drug} where vaso_rate is not null" for drug in DRUGS),
        "select unnest([starttime, endtime]) from ventilation where ventilation_status = 'InvasiveVent'",
        "select unnest([intime_hr, outtime_hr]) from icustay_times",
    ]
)
CLOSED = f"(select date_trunc('millisecond', max(t)) - interval 2 hour from ({SCORE_EVENTS}))"
MAXIMA = ", ".join(f"cast({o}_24hours as integer) as {o}_24hours" for o in SOFA_ORGANS)


@query(
    "stream_sofa",
    model_sql(
        "sofa",
        f"""
select stay_id, cast(hr as integer) as hr, endtime, {MAXIMA}, cast(sofa_24hours as integer) as sofa_24hours
from sofa where endtime < {CLOSED}""",
    ),
)
def _(s):
    """The score of every closed hour, from seven streams of readings and six of intervals."""
    use_rocksdb(s.spark)
    scored = scores.running_score(score_streams(s), "stay_id", "2 hours")
    rows = run_to_table(scored, scratch_dir(s.spark, "score"))
    return ntz_columns(rows.drop("alert"))


@query(
    "stream_sofa_alert",
    model_sql(
        "sofa",
        f"""
select stay_id, min(endtime) as alert_time, cast(arg_min(sofa_24hours, endtime) as integer) as score
from sofa where endtime < {CLOSED} and sofa_24hours >= 9 group by stay_id""",
    ),
)
def _(s):
    """One alert for each stay, at the first closed hour that reaches nine points."""
    use_rocksdb(s.spark)
    scored = scores.running_score(score_streams(s), "stay_id", "2 hours", threshold=9, alerts_only=True)
    alerts = scored.where("alert").select("stay_id", F.col("endtime").alias("alert_time"), F.col("sofa_24hours").alias("score"))
    return ntz_columns(run_to_table(alerts, scratch_dir(s.spark, "score_alert")))


@query(
    "stream_batch_check",
    """
select user_id, window_start, 'changed' as kind, 'n' as columns
from (select distinct user_id, date_trunc('hour', ts) as window_start from events)
where window_start + interval 1 hour <= (select max(ts) - interval 2 hour from events)
  and user_id % 10 = 3""",
)
def _(s):
    """Hours of the stream held against batch hours in which some users' counts were altered."""
    events = events_stream(s)
    count = F.count(F.lit(1)).alias("n")
    hours = windowed(events, "ts", "1 hour", "2 hours", ["user_id"], [count])
    started = F.col("w.start").alias("window_start")
    table = (
        s["events"]
        .groupBy("user_id", F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"))
        .agg(count)
        .select("user_id", started, F.col("w.end").alias("window_end"), "n")
    )
    altered = table.withColumn("n", F.col("n") + F.when(F.col("user_id") % 10 == 3, 1).otherwise(0))
    ledger, differences = checked_against_batch(
        hours, altered, ["user_id", "window_start"], scratch_dir(s.spark, "check")
    )
    off = ledger.agg(F.sum("n_differing").alias("n"), F.count_if(F.col("digest_batch") != F.col("digest_stream")).alias("batches")).first()
    if off.n != differences.count() or not off.batches:
        raise RuntimeError("the ledger does not count the differences")
    return ntz_columns(differences.drop("batch"))
