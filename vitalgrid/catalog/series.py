"""Time-series operators over the ``events`` and ``orders`` tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.catalog.registry import query
from vitalgrid.functions.cleaning import Bound, filter_items
from vitalgrid.functions.time import HOUR, elapsed, shift, trunc
from vitalgrid.operators import aggregates, ranking
from vitalgrid.operators.bands import around, first_in_band, first_match, hours_after, hours_before
from vitalgrid.operators.grid import (
    bucket_agg,
    hour_grid,
    interval_at_bucket_end,
    interval_to_hours,
)
from vitalgrid.operators.intervals import (
    backfill_first,
    bounded_join,
    point_in_interval,
    window_join,
)
from vitalgrid.operators.lookback import asof_lookback, prev_within
from vitalgrid.operators.pivot import Measure, pivot_items
from vitalgrid.operators.relational import star_merge, union_rows
from vitalgrid.operators.rolling import rolling_max_rows, trailing_sums
from vitalgrid.operators.sessions import collapse_sessions, gap_change_sessions, lag_in

KINDS = ("click", "error", "purchase", "signup", "view")
MONEY = "decimal(18,2)"


def user_bounds(events: DataFrame) -> DataFrame:
    return aggregates.time_bounds(events, ["user_id"], "ts")


def user_grid(events: DataFrame) -> DataFrame:
    return hour_grid(user_bounds(events), "user_id", "first_t", "last_t")


def of_kind(events: DataFrame, *kinds: str) -> DataFrame:
    return filter_items(events, "event_type", kinds)


GRID_SQL = """
select user_id, cast(h as integer) as hr, origin + to_hours(h) as endtime from (
  select user_id, unnest(generate_series(-24, date_diff('hour', min(ts), max(ts)))) as h,
    date_trunc('hour', min(ts) + interval 1 hour - interval 1 microsecond) as origin
  from events group by user_id)"""


@query("hour_grid", GRID_SQL)
def _(s):
    return user_grid(s["events"])


@query(
    "grid_bucket_max",
    f"""
select g.user_id, g.hr, g.endtime, max(e.value) as value_max, min(e.value) as value_min,
  nullif(count(e.event_id), 0) as n_events
from ({GRID_SQL}) g left join events e on e.user_id = g.user_id
  and e.ts > g.endtime - interval 1 hour and e.ts <= g.endtime
group by all""",
)
def _(s):
    events = s["events"]
    return bucket_agg(
        user_grid(events),
        events,
        "user_id",
        "ts",
        {
            "value_max": ("max", "value"),
            "value_min": ("min", "value"),
            "n_events": ("count", "event_id"),
        },
    )


PIVOT = tuple(Measure(k, (k,), Bound(5, 300, ("high",)), source="value") for k in KINDS)


@query(
    "event_pivot_max",
    "select user_id, cast(ts as date) as day, "
    + ", ".join(
        f"max(value) filter (where event_type = '{k}' and value > 5 and value <= 300) as {k}"
        for k in KINDS
    )
    + " from events group by all",
)
def _(s):
    rows = s["events"].withColumn("day", F.col("ts").cast("date"))
    return pivot_items(rows, ["user_id", "day"], PIVOT, "max", item="event_type")


@query(
    "event_pivot_avg",
    "select user_id, cast(ts as date) as day, "
    + ", ".join(
        f"cast(sum(cast(value as decimal(18,2))) filter (where event_type = '{k}' and value > 5 "
        f"and value <= 300) as double) / count(*) filter (where event_type = '{k}' and value > 5 "
        f"and value <= 300) as {k}_avg"
        for k in KINDS
    )
    + " from events group by all",
)
def _(s):
    rows = s["events"].select(
        "user_id",
        F.col("ts").cast("date").alias("day"),
        "event_type",
        "value",
        F.col("value").cast(MONEY).alias("exact"),
    )
    keep = Bound(5, 300, ("high",)).holds(F.col("value"))
    spec = []
    for k in KINDS:
        spec += [
            Measure(f"{k}_sum", (k,), source="exact", agg="sum"),
            Measure(f"{k}_n", (k,), source="exact", agg="count"),
        ]
    # A user's day without any plausible value still has a row.
    rows = rows.withColumn("exact", F.when(keep, F.col("exact")))
    wide = pivot_items(rows, ["user_id", "day"], spec, item="event_type")
    return wide.select(
        "user_id",
        "day",
        *[
            F.try_divide(F.col(f"{k}_sum").cast("double"), F.col(f"{k}_n")).alias(f"{k}_avg")
            for k in KINDS
        ],
    )


@query(
    "dedupe_latest",
    """
select user_id, event_type, cast(ts as date) as day, arg_max(event_id, (ts, event_id)) as event_id,
  arg_max(value, (ts, event_id)) as value
from events group by all""",
)
def _(s):
    rows = s["events"].withColumn("day", F.col("ts").cast("date"))
    latest = ranking.keep_latest(rows, ["user_id", "event_type", "day"], "ts", ["event_id"])
    return latest.select("user_id", "event_type", "day", "event_id", "value")


@query(
    "ordinal_spread",
    """
select user_id, cast(ts as date) as day, list(event_type order by ts, event_id)[1] as kind_1,
  list(event_type order by ts, event_id)[2] as kind_2,
  list(event_type order by ts, event_id)[3] as kind_3,
  list(event_type order by ts, event_id)[4] as kind_4
from events group by all""",
)
def _(s):
    rows = s["events"].withColumn("day", F.col("ts").cast("date"))
    return ranking.spread_ordinals(
        rows, ["user_id", "day"], [F.col("ts"), F.col("event_id")], "event_type", 4, "kind_"
    )


@query(
    "lag_elapsed",
    """
select user_id, event_id, date_diff('minute', ifnull(lag(ts) over w, min(ts) over (
  partition by user_id)), ts) as minutes_since
from events window w as (partition by user_id order by ts, event_id)""",
)
def _(s):
    events = s["events"].select("user_id", "event_id", "ts")
    first = user_bounds(events).select("user_id", "first_t")
    rows = ranking.lag_or(
        events.join(first, "user_id"), ["user_id"], "ts", "first_t", "before", ["event_id"]
    )
    return rows.select("user_id", "event_id", elapsed("minute", "before", "ts").alias("minutes_since"))


@query(
    "lag_two_levels",
    """
select event_id, lag(ts) over (partition by user_id, event_type order by ts) as same_kind_before,
  lag(ts) over (partition by user_id order by ts, event_type) as any_before
from events""",
)
def _(s):
    rows = lag_in(
        s["events"].select("user_id", "event_type", "ts", "event_id"),
        ["user_id", "event_type"],
        ["user_id"],
        "ts",
    )
    return rows.select(
        "event_id",
        F.col("prev_fine.ts").alias("same_kind_before"),
        F.col("prev_coarse.ts").alias("any_before"),
    )


@query(
    "prev_within_6h",
    """
select event_id, case when lag(ts) over w > ts - interval 6 hour then lag(value) over w end
  as prev_value
from events window w as (partition by user_id order by ts, event_id)""",
)
def _(s):
    rows = s["events"].select("user_id", "event_id", "ts", "value")
    found = prev_within(rows, "user_id", "ts", ["value"], 6 * HOUR, ties=["event_id"])
    return found.select("event_id", "prev_value")


@query(
    "lead_intervals",
    """
with o as (
  select o_custkey, o_orderkey, o_orderdate as starttime, o_totalprice,
    lead(o_orderdate) over w as following, row_number() over w as k,
    max(o_orderdate) over (partition by o_custkey) + interval 30 day as bound
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)
)
select o_custkey, o_orderkey, starttime, ifnull(following, bound) as endtime, o_totalprice from o
union all
select o_custkey, o_orderkey, timestamp '1992-06-01', starttime, o_totalprice
from o where k = 1 and starttime > timestamp '1992-06-01'""",
)
def _(s):
    orders = s["orders"].select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("starttime"), "o_totalprice"
    )
    last = orders.groupBy("o_custkey").agg(shift(F.max("starttime"), days=30).alias("bound"))
    closed = ranking.next_start_as_end(
        orders.join(last, "o_custkey"), ["o_custkey"], "starttime", "bound", "endtime",
        ["o_orderkey"],
    )
    firsts = ranking.top1(orders, ["o_custkey"], [F.col("starttime"), F.col("o_orderkey")])
    opening = F.lit("1992-06-01").cast("timestamp_ntz")
    gaps = backfill_first(
        firsts, last.select("o_custkey", opening.alias("opening")), "o_custkey", "starttime",
        "opening",
    )
    out = ["o_custkey", "o_orderkey", "starttime", "endtime", "o_totalprice"]
    filled = gaps.withColumn("endtime", F.col("starttime")).withColumn("starttime", opening)
    return union_rows(closed.select(*out), filled.select(*out))


@query(
    "point_in_interval",
    " union all ".join(
        f"""select '{b}' as bounds, p.event_id, i.event_id as span_id
from (select * from events where event_type in ('view', 'purchase')) p
left join (select * from events where event_type = 'purchase' and value > 20) i
  on i.user_id = p.user_id and p.ts {lo} i.ts and p.ts {hi} i.ts + interval 30 hour"""
        for b, lo, hi in (("[)", ">=", "<"), ("[]", ">=", "<="), ("(]", ">", "<="))
    ),
)
def _(s):
    events = s["events"].select("user_id", "event_id", "event_type", "ts", "value")
    points = of_kind(events, "view", "purchase").select("user_id", "event_id", "ts")
    spans = of_kind(events, "purchase").select(
        "user_id",
        F.col("event_id").alias("span_id"),
        F.col("ts").alias("start"),
        shift("ts", hours=30).alias("end"),
        "value",
    )
    parts = [
        point_in_interval(
            points, spans, ["user_id"], "ts", "start", "end", b, on_extra=F.col("value") > 20
        ).select(F.lit(b).alias("bounds"), "event_id", "span_id")
        for b in ("[)", "[]", "(]")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "asof_lookback",
    """
select p.event_id, p.user_id, arg_max(v.value, v.ts) as view_value, max(v.ts) as view_ts
from (select * from events where event_type = 'purchase') p
left join (select user_id, ts, max(value) as value from events where event_type = 'view'
  group by all) v
  on v.user_id = p.user_id and v.ts <= p.ts and v.ts >= p.ts - interval 2 hour
group by all""",
)
def _(s):
    events = s["events"].select("user_id", "event_id", "event_type", "ts", "value")
    views = (
        of_kind(events, "view")
        .groupBy("user_id", F.col("ts").alias("view_ts"))
        .agg(F.max("value").alias("view_value"))
        .withColumn("t", F.col("view_ts"))
    )
    return asof_lookback(
        of_kind(events, "purchase").select("event_id", "user_id", "ts"),
        views, ["user_id"], "ts", "t", ["view_value", "view_ts"], 2 * HOUR,
    ).drop("ts")


def _trailing(s):
    unique = (
        s["events"].groupBy("user_id", "ts").agg(F.sum(F.col("value").cast(MONEY)).alias("value"))
    )
    rows = s["events"].count()  # from the footers of the files
    return trailing_sums(
        unique, "user_id", "ts", {"sum": "value"}, {"_6hr": 5, "_12hr": 11}, "_24hr", rows=rows
    )


@query(
    "rolling_24h",
    """
with e as (select user_id, ts, sum(cast(value as decimal(18,2))) as v from events group by all)
select c.user_id, c.ts, cast(sum(p.v) as double) as sum_24hr
from e c join e p on p.user_id = c.user_id and p.ts <= c.ts and p.ts >= c.ts - interval 23 hour
group by all""",
)
def _(s):
    return _trailing(s).select("user_id", "ts", F.col("sum_24hr").cast("double"))


@query(
    "rolling_6h_clock",
    """
with e as (select user_id, ts, sum(cast(value as decimal(18,2))) as v from events group by all)
select c.user_id, c.ts,
  cast(sum(p.v) filter (where date_diff('hour', p.ts, c.ts) <= 5) as double) as sum_6hr,
  cast(sum(p.v) filter (where date_diff('hour', p.ts, c.ts) <= 11) as double) as sum_12hr
from e c join e p on p.user_id = c.user_id and p.ts <= c.ts and p.ts >= c.ts - interval 23 hour
group by all""",
)
def _(s):
    return _trailing(s).select(
        "user_id",
        "ts",
        F.col("sum_6hr").cast("double"),
        F.col("sum_12hr").cast("double"),
    )


@query(
    "first_match_band",
    """
with s as (
  select event_id as id, user_id, cast(ts as date) as day,
    case when event_id % 5 <> 0 then ts end as t from events where event_type = 'signup'
), pre as (
  select e.event_id, s.id from events e join s on s.user_id = e.user_id and case
    when t is not null then t < e.ts and e.ts <= t + interval 72 hour
    else cast(e.ts as date) between day and day + 3 end
  where event_type = 'error'
  qualify row_number() over (partition by e.event_id order by day, t, id) = 1
), post as (
  select e.event_id, s.id from events e join s on s.user_id = e.user_id and case
    when t is not null then t - interval 24 hour <= e.ts and e.ts < t
    else cast(e.ts as date) between day - 1 and day end
  where event_type = 'error'
  qualify row_number() over (partition by e.event_id order by day, t, id) = 1
)
select e.event_id, pre.id as signup_before, post.id as signup_after
from events e left join pre using (event_id) left join post using (event_id)
where event_type = 'error'""",
)
def _(s):
    events = s["events"].select("event_id", "user_id", "event_type", "ts")
    errors = of_kind(events, "error").select("event_id", "user_id", "ts")
    signups = of_kind(events, "signup").select(
        "user_id",
        "event_id",
        F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("t"),
    )
    matches = first_in_band(
        errors,
        signups,
        ["user_id"],
        "ts",
        {"before": hours_before(72), "after": hours_after(24)},
        F.struct("day", F.col("t").isNull().alias("untimed"), "t", "event_id"),
        "t",
        right_date="day",
        date_bands={"before": (-3, 0), "after": (0, 1)},
    )
    return first_match(errors, matches, ["user_id", "ts"]).select(
        "event_id",
        F.col("before.event_id").alias("signup_before"),
        F.col("after.event_id").alias("signup_after"),
    )


@query(
    "window_join_48_24",
    """
select p.event_id, arg_min(h.event_id, (h.ts, h.event_id)) as first_id, min(h.ts) as first_ts
from events p join events h on h.user_id = p.user_id and h.value > 60
  and h.ts between p.ts - interval 48 hour and p.ts + interval 24 hour
where p.event_type = 'purchase' group by all""",
)
def _(s):
    events = s["events"].select("event_id", "user_id", "event_type", "ts", "value")
    purchases = of_kind(events, "purchase").select("event_id", "user_id", F.col("ts").alias("at"))
    matches = first_in_band(
        purchases,
        events.where(F.col("value") > 60),
        ["user_id"],
        "at",
        {"high": around(48, 24)},
        F.struct("ts", "event_id"),
        "ts",
    ).where(F.col("high").isNotNull())
    return purchases.join(matches, ["user_id", "at"]).select(
        "event_id",
        F.col("high.event_id").alias("first_id"),
        F.col("high.ts").alias("first_ts"),
    )


@query(
    "window_join_pairs",
    """
select p.event_id as purchase_id, h.event_id as high_id
from events p join events h on h.user_id = p.user_id and h.value > 60
  and h.ts between p.ts - interval 48 hour and p.ts + interval 24 hour
where p.event_type = 'purchase'""",
)
def _(s):
    events = s["events"].select("event_id", "user_id", "event_type", "ts", "value")
    purchases = of_kind(events, "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("at")
    )
    highs = events.where(F.col("value") > 60).select(
        "user_id", F.col("event_id").alias("high_id"), "ts"
    )
    return window_join(purchases, highs, "user_id", "at", "ts", 48, 24).select(
        "purchase_id", "high_id"
    )


@query(
    "bounded_join_month",
    """
select o.o_orderkey, l.l_linenumber
from orders o join lineitem l on l.l_orderkey = o.o_orderkey
  and l.l_shipdate > o.o_orderdate - interval 1 month
  and l.l_shipdate < o.o_orderdate + interval 1 month""",
)
def _(s):
    orders = s["orders"].select(F.col("o_orderkey").alias("key"), "o_orderdate")
    lines = s["lineitem"].select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_shipdate")
    near = bounded_join(lines, orders, "key", "l_shipdate", "o_orderdate", "o_orderdate", 1)
    return near.select(F.col("key").alias("o_orderkey"), "l_linenumber")


SESSIONS_SQL = """
with l as (
  select user_id, ts, event_type as status,
    lag(ts) over (partition by user_id, event_type order by ts) as same_before,
    lag(event_type) over (partition by user_id order by ts, event_type) as status_before,
    lead(ts) over (partition by user_id order by ts, event_type) as after
  from events
), q as (
  select *, sum(case when status_before is null or status_before <> status
      or date_diff('hour', same_before, ts) >= 14 then 1 else 0 end)
    over (partition by user_id order by ts) as session
  from l
)"""


@query(
    "gap_change_sessions",
    SESSIONS_SQL + " select user_id, ts, status, after as next_t, cast(session as bigint) as "
    "session from q",
)
def _(s):
    rows = s["events"].select("user_id", "ts", F.col("event_type").alias("status"))
    return gap_change_sessions(rows, "user_id", "ts", "status", 14)


@query(
    "collapse_sessions",
    SESSIONS_SQL
    + """ select user_id, cast(session as bigint) as session, min(ts) as starttime,
  max(if(after is null or date_diff('hour', ts, after) >= 14, ts, after)) as endtime,
  max(status) as status
from q group by user_id, session having min(ts) <> max(ts)""",
)
def _(s):
    rows = s["events"].select("user_id", "ts", F.col("event_type").alias("status"))
    sessions = gap_change_sessions(rows, "user_id", "ts", "status", 14)
    return collapse_sessions(
        sessions, "user_id", "session", "ts", "next_t", 14, [F.max("status").alias("status")]
    )


@query(
    "rolling_max_24rows",
    f"""
with h as (
  select g.user_id, g.hr,
    {", ".join(f"max(e.value) filter (where event_type = '{k}') as {k}" for k in KINDS)},
    max(e.value) as top
  from ({GRID_SQL}) g left join events e on e.user_id = g.user_id
    and e.ts > g.endtime - interval 1 hour and e.ts <= g.endtime
  group by all
), r as (
  select user_id, hr, {", ".join(f"ifnull(max({k}) over w, 0) as {k}_24" for k in (*KINDS, "top"))}
  from h window w as (partition by user_id order by hr rows 23 preceding)
)
select *, {" + ".join(f"{k}_24" for k in sorted((*KINDS, "top")))} as total from r where hr >= 0""",
)
def _(s):
    events = s["events"]
    names = sorted((*KINDS, "top"))
    from vitalgrid.functions.time import ceil_hour

    features = events.select(
        "user_id",
        ceil_hour("ts").alias("endtime"),
        *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in KINDS],
        F.col("value").alias("top"),
    )
    hours = star_merge(
        user_grid(events), [features], ["user_id", "endtime"], [F.max(n).alias(n) for n in names]
    )
    rolled = rolling_max_rows(hours, "user_id", "hr", 24, names, "_24", total="total")
    return rolled.where(F.col("hr") >= 0).select(
        "user_id", "hr", *[n + "_24" for n in names], "total"
    )


@query(
    "interval_to_hours",
    """
select event_id, event_type, unnest(generate_series(date_trunc('hour', ts) + interval 1 hour,
  date_trunc('hour', ts + to_hours(1 + event_id % 5)), interval 1 hour)) as endtime
from events""",
)
def _(s):
    spans = s["events"].select(
        "event_id",
        "event_type",
        "ts",
        (F.col("ts") + F.make_dt_interval(F.lit(0), (1 + F.col("event_id") % 5).cast("int"))).alias(
            "stop"
        ),
    )
    return interval_to_hours(spans, "ts", "stop").select("event_id", "event_type", "endtime")


@query(
    "interval_at_bucket_end",
    f"""
select g.user_id, g.hr, {", ".join(f"max(e.value) filter (where event_type = '{k}') as {k}"
                                   for k in KINDS)}
from ({GRID_SQL}) g left join events e on e.user_id = g.user_id and e.ts < g.endtime
  and g.endtime <= e.ts + to_hours(1 + e.event_id % 5)
group by all""",
)
def _(s):
    events = s["events"]
    stop = F.col("ts") + F.make_dt_interval(F.lit(0), (1 + F.col("event_id") % 5).cast("int"))
    spans = events.select("user_id", "event_type", "value", "ts", stop.alias("stop"))
    rates = [F.max(F.when(F.col("event_type") == k, F.col("value"))).alias(k) for k in KINDS]
    return interval_at_bucket_end(user_grid(events), spans, "user_id", "ts", "stop", rates).drop(
        "endtime"
    )


@query(
    "surrogate_id",
    """
select o_orderkey, cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)
  as integer) as order_no from orders""",
)
def _(s):
    orders = s["orders"].select("o_custkey", "o_orderdate", "o_orderkey")
    numbered = ranking.surrogate_id(
        orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], "order_no"
    )
    return numbered.select("o_orderkey", "order_no")


@query(
    "rank_mixed_nulls",
    """
select o_orderkey, cast(row_number() over (partition by o_custkey order by
  case when o_orderstatus <> 'P' then o_orderdate end nulls last, o_orderkey) as integer) as rn
from orders""",
)
def _(s):
    """Orders without a settled date are numbered last."""
    orders = s["orders"].select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("settled"),
    )
    numbered = ranking.ordinal_within(orders, ["o_custkey"], "settled", ["o_orderkey"])
    return numbered.select("o_orderkey", "rn")


@query(
    "rank_after_group",
    """
select user_id, day, n, cast(row_number() over (partition by user_id order by day) as integer) as rn
from (select user_id, date_trunc('day', ts) as day, count(*) as n from events group by all)""",
)
def _(s):
    days = s["events"].select("user_id", trunc("day", "ts").alias("day"))
    return ranking.rank_after_group(
        days, ["user_id", "day"], [F.count(F.lit(1)).alias("n")], ["user_id"], "day"
    )


@query(
    "top1_four_columns",
    """
select o_custkey, o_orderkey from orders
qualify row_number() over (partition by o_custkey order by o_orderpriority, o_orderdate,
  o_totalprice, o_orderkey) = 1""",
)
def _(s):
    by = [F.col(c).asc_nulls_last() for c in
          ("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")]
    return ranking.top1(s["orders"], ["o_custkey"], by).select("o_custkey", "o_orderkey")
