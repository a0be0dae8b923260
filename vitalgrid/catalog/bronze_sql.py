"""The tables of ``sources.derived`` stated in SQL, over the ``events`` view."""

from __future__ import annotations

from vitalgrid.sources import derived

_IDS = (
    "30000000 + user_id as stay_id, 20000000 + user_id as hadm_id, "
    "10000000 + cast((user_id - user_id % 2) / 2 as bigint) as subject_id"
)


def _values(rows) -> str:
    return ", ".join(str(tuple(r)) for r in rows)


def _choose(values, by: str) -> str:
    arms = " ".join(
        f"when {i} then " + ("null" if v is None else f"'{v}'") for i, v in enumerate(values)
    )
    return f"case {by} % {len(values)} {arms} end"


BRONZE = {
    "icustays": f"""
select stay_id, hadm_id, subject_id, min(ts) as intime, max(ts) as outtime
from (select {_IDS}, ts from events) group by all""",
    "chartevents": f"""
select {_IDS}, ts + to_minutes(itemid % 5) as charttime,
  ts + to_minutes(cast(10 + event_id % 3 as integer)) as storetime, itemid,
  case itemid
    when 226732 then {_choose(derived.DEVICES, "event_id")}
    when 223849 then {_choose(derived.MODES, "event_id")}
    when 229314 then {_choose(derived.HAMILTON_MODES, "event_id")}
    else case when itemid = 223900 and event_id % 9 = 0 then 'No Response-ETT'
         else cast(lo + (event_id * 31 + itemid * 17) % span as varchar) end
  end as value,
  case when itemid not in (226732, 223849, 229314)
    then cast(lo + (event_id * 31 + itemid * 17) % span as double) * step end as valuenum
from events, (values {_values(derived.CHART_ITEMS)}) as i(itemid, lo, span, step)
where (event_id + itemid) % 3 = 0""",
    "labevents": f"""
select {_IDS}, event_id * 10 + case when itemid < 50850 or itemid = 52033 then 0 else 1 end
    as specimen_id, itemid, ts + interval 3 minute as charttime,
  ts + interval 20 minute as storetime,
  case when itemid = 52033 then case when event_id % 4 = 0 then 'ART.' else 'VEN.' end end as value,
  case when itemid <> 52033
    then cast(lo + (event_id * 13 + itemid * 7) % span as double) * step end as valuenum
from events, (values {_values(derived.LAB_ITEMS)}) as i(itemid, lo, span, step)
where (itemid < 50850 or itemid = 52033) = (event_id % 2 = 0)""",
    "inputevents": f"""
select {_IDS}, event_id as linkorderid,
  case event_id % 4 when 0 then 221289 when 1 then 221906 when 2 then 221662 else 221653 end
    as itemid,
  ts as starttime, ts + to_hours(2 + event_id % 9) as endtime,
  cast(event_id % 97 as double) as amount,
  case when event_id % 4 < 2 then cast(event_id % 200 as double) / 1000
    else cast(event_id % 25 as double) end as rate,
  case when event_id % 25 = 1 then 'mg/kg/min' else 'mcg/kg/min' end as rateuom,
  case when event_id % 50 = 1 then 1.0 else 70.0 end as patientweight
from events where event_type = 'purchase'""",
    "outputevents": f"""
select {_IDS}, ts as charttime,
  case event_id % 4 when 0 then 226559 when 1 then 226560 when 2 then 227488 else 227489 end
    as itemid,
  cast(20 + event_id % 400 as double) as value
from events where event_type in ('view', 'error')""",
    "prescriptions": f"""
select {_IDS}, ts as starttime, ts + interval 2 day as stoptime,
  {_choose(derived.DRUGS, "event_id")} as drug, {_choose(derived.ROUTES, "event_id")} as route,
  case when event_id % 7 = 0 then 'BASE' else 'MAIN' end as drug_type
from events where event_type = 'click'""",
    "microbiologyevents": f"""
select {_IDS}, event_id as micro_specimen_id, cast(ts as date) as chartdate,
  case when event_id % 5 <> 0 then ts end as charttime,
  case when event_id % 11 <> 0 then
    case when event_id % 2 = 0 then 'BLOOD CULTURE' else 'URINE' end end as spec_type_desc,
  case event_id % 3 when 1 then 'E. COLI' when 2 then '' end as org_name,
  case when event_id % 4 = 0 then 90856 else 80002 end as org_itemid
from events where event_type = 'error'""",
}
