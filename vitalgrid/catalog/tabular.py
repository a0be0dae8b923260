"""Projections, predicates, joins, aggregates, quality and reports over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.catalog.registry import query
from vitalgrid.functions import cleaning, rules
from vitalgrid.functions.time import ceil_hour, elapsed, shift, shift_months, trunc
from vitalgrid.operators import aggregates, cohort, quality, relational, usage
from vitalgrid.plans import items

MONEY = "decimal(18,2)"


@query(
    "clock_functions",
    """
select event_id, date_diff('hour', ts, ts + interval 2 minute) as hours_2m,
  date_diff('minute', timestamp '2024-01-01', ts) as minutes_since,
  date_trunc('hour', ts + interval 1 hour - interval 1 microsecond) as hour_up,
  date_trunc('day', ts) as day, ts - interval 1 month as month_before,
  ts + interval 36 hour as later
from events""",
)
def _(s):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return s["events"].select(
        "event_id",
        elapsed("hour", "ts", shift("ts", minutes=2)).alias("hours_2m"),
        elapsed("minute", start, F.col("ts")).alias("minutes_since"),
        ceil_hour("ts").alias("hour_up"),
        trunc("day", "ts").alias("day"),
        shift_months("ts", -1).alias("month_before"),
        shift("ts", hours=36).alias("later"),
    )


@query(
    "filter_items",
    """
select event_id, event_type, value from events
where event_type in ('purchase', 'view') and value is not null and props is not null""",
)
def _(s):
    rows = cleaning.require(s["events"], ["value", "props"])
    return cleaning.filter_items(rows, "event_type", ["view", "purchase"]).select(
        "event_id", "event_type", "value"
    )


@query(
    "bounded_values",
    """
select event_id, case event_type
  when 'view' then case when value > 10 and value < 100 then value end
  when 'click' then case when value >= 10 and value <= 100 then value end
  when 'error' then case when value <= 50 then value end
  else value end as kept
from events""",
)
def _(s):
    bounds = {
        "view": cleaning.Bound(10, 100),
        "click": cleaning.Bound(10, 100, ("low", "high")),
        "error": cleaning.Bound(None, 50, ("high",)),
    }
    return s["events"].select(
        "event_id", cleaning.bounded("value", "event_type", bounds).alias("kept")
    )


@query(
    "positive_except",
    """
select l_orderkey, l_linenumber, l_quantity - 25 as surplus from lineitem
where l_quantity - 25 > 0 or l_returnflag = 'N'""",
)
def _(s):
    rows = s["lineitem"].withColumn("surplus", F.col("l_quantity") - 25)
    return rows.where(cleaning.positive_except("surplus", "l_returnflag", ["N"])).select(
        "l_orderkey", "l_linenumber", "surplus"
    )


@query(
    "unit_normalise",
    """
select event_id,
  case when value > 20 and value <= 100 then value
    when value > 0.2 and value <= 1 then value * 100 end as pct_lab,
  case when value >= 20 and value <= 100 then value
    when value > 0.2 and value <= 1 then value * 100 end as pct_chart,
  case when value between 20 and 100 then value
    when value between 0.2 and 1 then value * 100 end as pct_ventilator,
  case when event_type = 'view' then (value - 32) / 1.8 else value end as scaled,
  case when event_type = 'error' and user_id % 10 <> 1 then value * 1000 else value end as dose,
  case when event_type = 'signup' then 'view' else event_type end as kind
from events""",
)
def _(s):
    unit = F.when(F.col("event_type") == "error", "mg/kg/min").otherwise("mcg/kg/min")
    return s["events"].select(
        "event_id",
        *[
            cleaning.fio2_percent("value", rule).alias(f"pct_{rule}")
            for rule in ("lab", "chart", "ventilator")
        ],
        cleaning.to_celsius("value", "event_type", ["view"]).alias("scaled"),
        cleaning.dose_mcg("value", unit, F.col("user_id") % 10).alias("dose"),
        cleaning.merge_codes("event_type", {"signup": "view"}).alias("kind"),
    )


@query(
    "pattern_classify",
    """
with pair as (
  select distinct p_brand, p_type from part
  where (contains(lower(p_name), 'ring') or contains(lower(p_name), 'bolt')
      or contains(lower(p_name), 'wid'))
    and p_size not in (7, 14, 21) and not contains(lower(p_name), 'small')
)
select p_partkey, case when p_size < 10 then 'small' when p_size < 30 then 'medium'
  when p_size < 45 then 'large' end as size_class
from part where (p_brand, p_type) in (select (p_brand, p_type) from pair)""",
)
def _(s):
    part = s["part"]
    pairs = part.where(rules.matches_any("p_name", ["Ring", "bolt", "wid", "widget"]))
    pairs = rules.exclude(pairs, "p_size", [7, 14, 21])
    pairs = rules.exclude(pairs, "p_name", substrings=["small"])
    kept = relational.semi_pair(
        part, relational.distinct_rows(pairs, ["p_brand", "p_type"]), ["p_brand", "p_type"]
    )
    size = F.col("p_size")
    label = rules.classify([(size < 10, "small"), (size < 30, "medium"), (size < 45, "large")])
    return kept.select("p_partkey", label.alias("size_class"))


_ABX_SQL = " or ".join(f"contains(lower(text), '{p}')" for p in items.ANTIBIOTIC_PATTERNS)


@query("pattern_match_long_list", f"select doc_id, ({_ABX_SQL}) as hit from documents")
def _(s):
    """The full pattern list against whole texts."""
    return s["documents"].select(
        "doc_id", rules.matches_any("text", items.ANTIBIOTIC_PATTERNS).alias("hit")
    )


@query(
    "score_ladder",
    """
select o_orderkey, case when p < 20000 then 4 when p < 50000 then 3 when p < 100000 then 2
  when p < 150000 then 1 when p is not null then 0 end as points
from (select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end as p from orders)""",
)
def _(s):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    steps = [(price < 20000, 4), (price < 50000, 3), (price < 100000, 2), (price < 150000, 1)]
    return s["orders"].select(
        "o_orderkey", rules.score_ladder(steps, price.isNull()).alias("points")
    )


@query(
    "ratio_fallback",
    """
select event_id, 100 * value / coalesce(a, b) as ratio,
  coalesce(a, b) / 100.0 * 713 - value / 0.8 - value as gradient
from (select *, case when event_type = 'view' then 40.0::double end as a,
  case when event_type <> 'error' then 21.0::double end as b from events)""",
)
def _(s):
    value = F.col("value")
    first = F.when(F.col("event_type") == "view", F.lit(40.0))
    second = F.when(F.col("event_type") != "error", F.lit(21.0))
    return s["events"].select(
        "event_id",
        rules.pf_ratio(value, first, second).alias("ratio"),
        rules.aa_gradient(value, value, first, second).alias("gradient"),
    )


@query(
    "any_flag",
    """
select l_orderkey, max(case when l_returnflag <> '' and l_linenumber <> 3 then 1 else 0 end) as flag
from lineitem group by l_orderkey""",
)
def _(s):
    flag = rules.positive_flag("l_returnflag", "l_linenumber", 3) == 1
    return aggregates.any_flag(s["lineitem"], ["l_orderkey"], flag, "flag")


@query(
    "join_inner_left",
    """
select c.c_custkey, n.n_name, r.r_name, o.o_orderkey
from customer c join nation n on n.n_nationkey = c.c_nationkey
join region r on r.r_regionkey = n.n_regionkey
left join orders o on o.o_custkey = c.c_custkey""",
)
def _(s):
    nation = s["nation"].withColumnRenamed("n_regionkey", "r_regionkey")
    customer = s["customer"].withColumnRenamed("c_nationkey", "n_nationkey")
    placed = relational.join_inner(
        customer, relational.join_inner(nation, s["region"], "r_regionkey"), "n_nationkey"
    )
    orders = s["orders"].select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return relational.join_left(placed, orders, "c_custkey").select(
        "c_custkey", "n_name", "r_name", "o_orderkey"
    )


_STAR = {
    "views": ("view", "count(*)"),
    "clicks": ("click", "count(*)"),
    "spent": ("purchase", "max(value)"),
}


@query(
    "star_left",
    "with h as (select distinct user_id, date_trunc('hour', ts) as hr from events)"
    + "".join(
        f", {n} as (select user_id, date_trunc('hour', ts) as hr, {a} as {n} from events "
        f"where event_type = '{k}' group by all)"
        for n, (k, a) in _STAR.items()
    )
    + " select user_id, hr, views, clicks, spent from h "
    + " ".join(f"left join {n} using (user_id, hr)" for n in _STAR),
)
def _(s):
    rows = s["events"].withColumn("hr", trunc("hour", "ts"))
    at = ["user_id", "hr"]
    aggs = {"views": F.count(F.lit(1)), "clicks": F.count(F.lit(1)), "spent": F.max("value")}
    features = [
        rows.where(F.col("event_type") == kind).groupBy(*at).agg(aggs[name].alias(name))
        for name, (kind, _) in _STAR.items()
    ]
    return relational.star_left(relational.distinct_rows(rows, at), features, at)


@query(
    "signed_sum",
    """
select l_suppkey, cast(sum(cast(if(l_returnflag = 'R' and l_quantity > 0, -l_quantity, l_quantity)
  as decimal(18,2))) as double) as net
from lineitem group by l_suppkey""",
)
def _(s):
    rows = s["lineitem"].withColumn(
        "net", cleaning.signed_volume("l_quantity", "l_returnflag", ["R"]).cast(MONEY)
    )
    return aggregates.sum_by(rows, ["l_suppkey"], "net").withColumn("net", F.col("net").cast("double"))


@query(
    "sum_distinct_day",
    """
select l_shipdate, cast(sum(distinct cast(l_quantity as decimal(18,2))) as double) as quantity
from lineitem group by l_shipdate""",
)
def _(s):
    rows = s["lineitem"].withColumn("q", F.col("l_quantity").cast(MONEY))
    return aggregates.sum_distinct_by(rows, ["l_shipdate"], "q", "quantity").withColumn(
        "quantity", F.col("quantity").cast("double")
    )


@query(
    "conditional_sums",
    """
select l_orderkey, cast(sum(cast(l_extendedprice as decimal(18,2)))
    filter (where l_returnflag = 'R') as double) as returned,
  cast(sum(cast(l_extendedprice as decimal(18,2))) filter (where l_discount > 0.05) as double)
    as discounted
from lineitem group by l_orderkey""",
)
def _(s):
    price = F.col("l_extendedprice").cast(MONEY)
    sums = aggregates.conditional_sums(
        s["lineitem"],
        ["l_orderkey"],
        {
            "returned": (F.col("l_returnflag") == "R", price),
            "discounted": (F.col("l_discount") > 0.05, price),
        },
    )
    return sums.select(
        "l_orderkey",
        *[F.col(c).cast("double").alias(c) for c in ("returned", "discounted")],
    )


@query(
    "having_span",
    """
select user_id, cast(ts as date) as day, min(ts) as first_t, max(ts) as last_t
from events group by all having min(ts) <> max(ts)""",
)
def _(s):
    rows = s["events"].withColumn("day", F.col("ts").cast("date"))
    bounds = [F.min("ts").alias("first_t"), F.max("ts").alias("last_t")]
    return aggregates.having(
        rows, ["user_id", "day"], bounds, F.col("first_t") != F.col("last_t")
    )


@query(
    "constant_and_count",
    """
select o_orderkey, max(o_custkey) as o_custkey, count(*) as n
from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey""",
)
def _(s):
    rows = s["orders"].join(
        s["lineitem"].select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey"
    )
    return aggregates.constant_in_group(rows, ["o_orderkey"], ["o_custkey"], count="n")


@query(
    "preagg_join",
    """
select o_orderkey, o_totalprice, q.quantity
from orders left join (select l_orderkey, max(l_quantity) as quantity from lineitem group by all) q
  on q.l_orderkey = o_orderkey""",
)
def _(s):
    lines = aggregates.preagg(
        s["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey"),
        ["o_orderkey"],
        [F.max("l_quantity").alias("quantity")],
    )
    return s["orders"].select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left")


@query("count_all", "select count(*) as n from lineitem")
def _(s):
    return aggregates.count_by(s["lineitem"])


@query(
    "union_keys_left_join",
    """
with k as (
  select user_id, date_trunc('hour', ts) as hr from events where event_type = 'view'
  union select user_id, date_trunc('hour', ts) from events where event_type = 'click'
), v as (select user_id, date_trunc('hour', ts) as hr, max(value) as view_max from events
  where event_type = 'view' group by all),
c as (select user_id, date_trunc('hour', ts) as hr, max(value) as click_max from events
  where event_type = 'click' group by all)
select * from k left join v using (user_id, hr) left join c using (user_id, hr)""",
)
def _(s):
    rows = s["events"].withColumn("hr", trunc("hour", "ts"))
    at = ["user_id", "hr"]

    def side(kind):
        return (
            rows.where(F.col("event_type") == kind)
            .groupBy(*at)
            .agg(F.max("value").alias(f"{kind}_max"))
        )

    views, clicks = side("view"), side("click")
    keys = relational.union_keys([views, clicks], at)
    return relational.join_left(relational.join_left(keys, views, at), clicks, at)


@query(
    "full_outer_as_left",
    """
select v.user_id, v.event_id, c.event_id as click_id
from (select *, date_trunc('hour', ts) as hr from events where event_type = 'view') v
full join (select *, date_trunc('hour', ts) as hr from events where event_type = 'click') c
  on c.user_id = v.user_id and c.hr = v.hr
where v.event_id is not null""",
)
def _(s):
    rows = s["events"].select("user_id", "event_id", "event_type", trunc("hour", "ts").alias("hr"))
    views = rows.where(F.col("event_type") == "view").drop("event_type")
    clicks = rows.where(F.col("event_type") == "click").select(
        "user_id", "hr", F.col("event_id").alias("click_id")
    )
    return relational.outer_pairs(views, clicks, ["user_id", "hr"]).drop("hr")


@query(
    "union_rows",
    "select c_custkey as id, c_acctbal as balance from customer "
    "union all select s_suppkey, s_acctbal from supplier",
)
def _(s):
    customers = s["customer"].select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    suppliers = s["supplier"].select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")
    )
    return relational.union_rows(customers, suppliers)


@query(
    "order_by_key",
    "select o_orderkey, o_custkey from orders order by o_orderkey",
)
def _(s):
    return relational.order(s["orders"].select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query(
    "top_orders",
    """
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20""",
)
def _(s):
    return relational.top_n(
        s["orders"].select("o_orderkey", "o_totalprice"),
        [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")],
        20,
    )


@query(
    "dq_violations",
    """
select 'order key unique' as rule, count(*) as n_bad from (
  select o_orderkey from orders group by all having count(*) > 1)
union all select 'line unique', count(*) from (
  select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1)
union all select 'line has order', count(*) from lineitem
  where l_orderkey not in (select o_orderkey from orders)
union all select 'label has document', count(*) from labels
  where doc_id not in (select doc_id from documents)
union all select 'status accepted', count(*) from orders where o_orderstatus not in ('F', 'O')
union all select 'discount in range', count(*) from lineitem
  where l_discount < 0.01 or l_discount > 0.09
union all select 'quantity in range', count(*) from lineitem
  where l_quantity < 2 or l_quantity > 49
union all select 'order dated', count(*) from orders where o_orderdate is null
union all select 'event complete', count(*) from events where value is null or props is null
union all select 'price positive', count(*) from part where not p_retailprice > 905""",
)
def _(s):
    orders, lines = s["orders"], s["lineitem"]
    across = quality.rule_counts(
        {
            "order key unique": quality.unique(orders, ["o_orderkey"]),
            "line unique": quality.unique(lines, ["l_orderkey", "l_linenumber"]),
            "line has order": quality.relationships(lines, orders, "l_orderkey", "o_orderkey"),
            "label has document": quality.relationships(s["labels"], s["documents"], "doc_id"),
            "event complete": quality.not_null(s["events"], ["value", "props"]),
            "price positive": quality.violations(s["part"], F.col("p_retailprice") > 905),
        }
    )
    of_orders = {
        "status accepted": quality.outside("o_orderstatus", ["F", "O"]),
        "order dated": quality.missing(["o_orderdate"]),
    }
    of_lines = {
        "discount in range": quality.outside("l_discount", low=0.01, high=0.09),
        "quantity in range": quality.outside("l_quantity", low=2, high=49),
    }
    return across.unionByName(quality.row_rule_counts(orders, of_orders)).unionByName(
        quality.row_rule_counts(lines, of_lines)
    )


_PROFILED = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query(
    "table_profile",
    " union all ".join(
        f"""select '{c}' as "column", count(*) as n_rows, count(*) - count({c}) as n_null,
  cast(min({c}) as varchar) as lowest, cast(max({c}) as varchar) as highest from customer"""
        for c in _PROFILED
    ),
)
def _(s):
    return quality.profile(s["customer"], _PROFILED)


@query(
    "table_diff",
    """
with a as (select * from part where p_size <> 50),
b as (select * replace (if(p_size < 3, p_retailprice + 1, p_retailprice) as p_retailprice,
  if(p_size = 2, 'x', p_type) as p_type) from part where p_size <> 1)
select p_partkey, case when b.p_name is null then 'only in first' when a.p_name is null
    then 'only in second' else 'changed' end as kind,
  case when a.p_name is not null and b.p_name is not null then 'p_type,p_retailprice' end
    as columns
from a full join b using (p_partkey)
where a.p_name is null or b.p_name is null or a.p_retailprice <> b.p_retailprice""",
)
def _(s):
    part = s["part"]
    size = F.col("p_size")
    changed = part.where(size != 1).select(
        "p_partkey",
        "p_name",
        "p_brand",
        F.when(size == 2, "x").otherwise(F.col("p_type")).alias("p_type"),
        "p_size",
        F.when(size < 3, F.col("p_retailprice") + 1)
        .otherwise(F.col("p_retailprice"))
        .alias("p_retailprice"),
    )
    return quality.table_diff(part.where(size != 50), changed, ["p_partkey"])


@query(
    "attrition",
    """
with f as (
  select count(*) as a, count(*) filter (where c_acctbal > 0) as b,
    count(*) filter (where c_acctbal > 0 and c_mktsegment <> 'MACHINERY') as c,
    count(*) filter (where c_acctbal > 0 and c_mktsegment <> 'MACHINERY' and c_nationkey < 20) as d
  from customer
)
select 0 as step, 'all' as reason, a as n_left, 0::bigint as n_lost from f
union all select 1, 'in credit', b, a - b from f
union all select 2, 'not machinery', c, b - c from f
union all select 3, 'nation below 20', d, c - d from f""",
)
def _(s):
    return cohort.attrition(
        s["customer"],
        [
            ("in credit", F.col("c_acctbal") > 0),
            ("not machinery", F.col("c_mktsegment") != "MACHINERY"),
            ("nation below 20", F.col("c_nationkey") < 20),
        ],
    )


@query(
    "small_cell",
    """
select c_nationkey, c_mktsegment, case when count(*) >= 12 then count(*) end as n
from customer group by all""",
)
def _(s):
    counts = aggregates.count_by(s["customer"], ["c_nationkey", "c_mktsegment"])
    return cohort.suppress_small(counts, "n", 12)


@query(
    "text_cohort",
    """
select doc_id, quality, toxic from labels
where doc_id in (select doc_id from documents where contains(lower(text), 'license'))""",
)
def _(s):
    return cohort.text_cohort(s["documents"], "text", s["labels"], "doc_id", "License")


@query("seeded_sample")
def _(s):
    """The sample itself is the result; which rows it holds is Spark's choice for the seed."""
    return cohort.seeded_sample(s["orders"], 0.1, 42)


@query("keyed_sample", "select * from orders where md5('42:' || o_orderkey) < '1999999a'")
def _(s):
    return cohort.keyed_sample(s["orders"], ["o_orderkey"], 0.1, 42)


_PRICES = [("user", 3.0, 15.0), ("assistant", 5.0, 25.0)]

_USAGE_SQL = """
with r as (
  select cast(conv_id as varchar) as session, if(role = 'system', 'sub', 'main') as scope,
    role as model, if(role <> 'assistant', length(text), 0) as input,
    if(role = 'assistant', length(text), 0) as output, turn * 10 as cache_write_1h,
    turn as cache_write_5m, turn * 100 as cache_read
  from conversations
), c as (
  select r.*, (input * i + output * o + cache_write_1h * i * 2 + cache_write_5m * i * 1.25
    + cache_read * i * 0.1) as cost
  from r left join (values ('user', 3::decimal(12,4), 15::decimal(12,4)),
    ('assistant', 5::decimal(12,4), 25::decimal(12,4))) p(model, i, o) using (model)
), d as (
  select unnest([{'dimension': 'model', 'name': model}, {'dimension': 'scope', 'name': scope},
    {'dimension': 'session', 'name': session}]) as k, c.* from c
), t as (
  select k.dimension as dimension, k.name as name, count(*) as requests,
    cast(sum(input) as bigint) as input, cast(sum(output) as bigint) as output,
    cast(sum(cache_write_1h) as bigint) as cache_write_1h,
    cast(sum(cache_write_5m) as bigint) as cache_write_5m,
    cast(sum(cache_read) as bigint) as cache_read,
    cast(cast(sum(cost) as decimal(28,6)) as double) / 1000000 as cost
  from d group by all
)
select * from t where dimension <> 'session'
union all (select * from t where dimension = 'session' order by cost desc nulls last, name limit 10)
"""


@query("usage_rollup", _USAGE_SQL)
def _(s):
    """Every request is logged twice; the second line must not count."""
    turns = s["conversations"]
    size = F.length("text").cast("long")
    said = F.col("role") == "assistant"
    records = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.lit(0).alias("line_order"),
        F.col("conv_id").cast("string").alias("session"),
        F.when(F.col("role") == "system", "sub").otherwise("main").alias("scope"),
        F.col("role").alias("model"),
        F.when(~said, size).otherwise(F.lit(0)).alias("input"),
        F.when(said, size).otherwise(F.lit(0)).alias("output"),
        (F.col("turn") * 10).alias("cache_write_1h"),
        F.col("turn").alias("cache_write_5m"),
        (F.col("turn") * 100).alias("cache_read"),
    )
    repeated = records.withColumn("line_order", F.lit(1)).withColumn("input", F.col("input") * 9)
    prices = s.spark.createDataFrame(
        _PRICES, "model string, input_price double, output_price double"
    )
    return usage.usage_rollup(records.unionByName(repeated), prices)
