"""The clinical models and the cohort reports built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.catalog.models_sql import model_sql
from vitalgrid.catalog.registry import Source, query
from vitalgrid.operators import cohort
from vitalgrid.plans.graph import MODELS, Tables
from vitalgrid.session import scratch_dir, small_broadcasts
from vitalgrid.sources.derived import bronze


def tables_for(s: Source, name: str) -> Tables:
    """Everything a model needs; shared tables below it are written to scratch space.

    The session keeps small broadcasts for the plan that reads them, until the next ``Source``.
    """
    small_broadcasts(s.spark)
    tables = Tables(bronze(s["events"]), scratch_dir(s.spark, name))
    tables.prepare(name)
    return tables


def _register(name: str) -> None:
    @query(f"model_{name}", model_sql(name))
    def _(s):
        plan, _ = MODELS[name]
        return plan(tables_for(s, name))


for _name in MODELS:
    _register(_name)


@query(
    "bg_with_spo2",
    model_sql(
        "bg",
        """
select b.subject_id, b.charttime, b.po2, round(arg_max(v.spo2, v.charttime), 6) as spo2
from bg b left join (
  select subject_id, charttime, avg(valuenum) as spo2 from chartevents
  where itemid = 220277 and valuenum > 0 and valuenum <= 100 group by all) v
  on v.subject_id = b.subject_id
  and v.charttime between b.charttime - interval 2 hour and b.charttime
group by all""",
    ),
)
def _(s):
    from vitalgrid.plans.labs import bg_with_spo2

    rows = bg_with_spo2(tables_for(s, "bg"))
    return rows.select("subject_id", "charttime", "po2", F.round("spo2", 6).alias("spo2"))


@query(
    "cohort_summary",
    model_sql(
        "sepsis3",
        """
select c.stay_id, c.subject_id, c.sepsis3, c.sofa_score,
  date_diff('hour', t.intime_hr, t.outtime_hr) as icu_los_hours
from sepsis3 c join icustay_times t on t.stay_id = c.stay_id""",
    ),
)
def _(s):
    tables = tables_for(s, "sepsis3")
    rows = cohort.sepsis_cohort(tables["sepsis3"], tables["icustay_times"])
    return rows.select("stay_id", "subject_id", "sepsis3", "sofa_score", "icu_los_hours")


@query(
    "alert_delay",
    model_sql(
        "sepsis3",
        """
select cast(floor(d / 24) as integer) as delay_days, count(*) as n_cases, min(d) as shortest_hours,
  max(d) as longest_hours
from (select date_diff('hour', t.intime_hr, c.sofa_time) as d
  from sepsis3 c join icustay_times t on t.stay_id = c.stay_id) group by all""",
    ),
)
def _(s):
    tables = tables_for(s, "sepsis3")
    rows = cohort.sepsis_cohort(tables["sepsis3"], tables["icustay_times"])
    return cohort.alert_delay(rows, "intime_hr", "sofa_time")


@query(
    "incidence",
    model_sql(
        "suspicion_of_infection",
        """
select cast(date_trunc('day', s.intime) as date) as admitted, count(*) as n_stays,
  count(c.stay_id) as n_cases, count(c.stay_id) / count(*) as share
from icustays s left join (select distinct stay_id from suspicion_of_infection
  where suspected_infection = 1) c on c.stay_id = s.stay_id
group by all""",
    ),
)
def _(s):
    tables = tables_for(s, "suspicion_of_infection")
    cases = tables["suspicion_of_infection"].where(F.col("suspected_infection") == 1)
    admitted = F.col("intime").cast("date").alias("admitted")
    return cohort.incidence(tables["icustays"], cases, "stay_id", [admitted])


@query(
    "sofa_trajectory",
    model_sql(
        "sofa",
        """
select cast(floor(hr / 24) as integer) as block, count(*) as n_hours,
  cast(sum(sofa_24hours) as bigint) as score_total, max(sofa_24hours) as score_max
from sofa group by all""",
    ),
)
def _(s):
    return cohort.trajectory(tables_for(s, "sofa")["sofa"], "hr", "sofa_24hours")
