"""Operators that cut a key's time axis, against plain windows, self joins and brute force.

Widths are far smaller than the data, so every key spans many blocks; one key holds a third of the
rows; keys and times can be missing.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from vitalgrid.functions.time import DAY, HOUR, micros
from vitalgrid.operators import chunks
from vitalgrid.operators.bands import around, first_in_band, hours_after, hours_before
from vitalgrid.operators.grid import bucket_agg, bucket_agg_range_join, hour_grid, interval_at_bucket_end
from vitalgrid.operators.intervals import RADIX, _cells, listed, point_in_interval
from vitalgrid.operators.lookback import asof_lookback, prev_within
from vitalgrid.operators.relational import star_left, star_merge
from vitalgrid.operators.rolling import rolling_max_rows, trailing_sums, trailing_sums_self_join
from vitalgrid.operators.sessions import gap_change_sessions

START = dt.datetime(2024, 1, 1)
SCHEMA = "k long, t timestamp_ntz, id long, v long, s string"


def sample(n: int, seed: int, missing: bool = True, days: int = 12):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if rnd.random() < 0.34 else rnd.randint(2, 9)
        # Whole minutes, so that equal times and exact limits occur.
        t = START + dt.timedelta(minutes=rnd.randrange(days * 24 * 60))
        if rnd.random() < 0.2:
            t = t.replace(minute=0)
        if missing and rnd.random() < 0.02:
            key = None
        if missing and rnd.random() < 0.02:
            t = None
        out.append((key, t, i, rnd.randint(0, 50), rnd.choice("ABC")))
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(sample(1500, 1), SCHEMA).cache()


@pytest.fixture(scope="module")
def unique(spark):
    """One row per key and time, nothing missing."""
    seen, kept = set(), []
    for r in sample(1500, 2, missing=False):
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            kept.append(r)
    return spark.createDataFrame(kept, SCHEMA).cache()


def plain(*order):
    return Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in order])


def test_neighbours(log):
    got = chunks.neighbours(log, ["k"], "t", ["id"], ["id"], "p", "n", width=6 * HOUR)
    want = log.select(
        "id",
        F.lag("id").over(plain("t", "id")).alias("p"),
        F.lead("id").over(plain("t", "id")).alias("n"),
    )
    assert rows(got, "id", "p.id", "n.id") == rows(want, "id", "p", "n")


def test_row_number(log):
    got = chunks.row_number_by_key(log, ["k"], "t", "rn", ["id"], width=5 * HOUR)
    want = log.withColumn("rn", F.row_number().over(plain("t", "id")))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")


def test_running_total_shares_ties(log):
    got = chunks.running_total(log, ["k"], "t", "v", "total", width=5 * HOUR)
    want = log.withColumn("total", F.sum("v").over(plain("t")))
    assert rows(got, "id", "total") == rows(want, "id", "total")


def test_prev_within(log):
    got = prev_within(log, "k", "t", ["id"], 6 * HOUR, ties=["id"], width=8 * HOUR)
    w = plain("t", "id")
    young = micros("t") - micros("pt") < 6 * HOUR
    want = (
        log.withColumn("p", F.lag("id").over(w))
        .withColumn("pt", F.lag("t").over(w))
        .withColumn("p", F.when(young & F.col("k").isNotNull(), F.col("p")))
    )
    assert rows(got, "id", "prev_id") == rows(want, "id", "p")


def test_asof(log, unique):
    got = asof_lookback(
        log, unique.select("k", F.col("t").alias("rt"), F.col("id").alias("rid")),
        ["k"], "t", "rt", ["rid"], 2 * HOUR, width=3 * HOUR,
    )
    right = sorted((r.k, r.t, r.id) for r in unique.collect())
    want = []
    for r in log.collect():
        hits = [
            (t, i)
            for k, t, i in right
            if r.k == k and r.t is not None and r.t - dt.timedelta(hours=2) <= t <= r.t
        ]
        want.append((r.id, max(hits)[1] if hits else None))
    assert dict(rows(got, "id", "rid")) == dict(want)


def test_sessions(log):
    got = gap_change_sessions(log, "k", "t", "s", 14, width=9 * HOUR)
    known = log.where("k is not null and t is not null")
    hour = lambda c: F.unix_timestamp(F.date_trunc("hour", F.col(c)).cast("timestamp")) / 3600
    same = Window.partitionBy("k", "s").orderBy("t")
    order = Window.partitionBy("k").orderBy("t", "s")
    flagged = (
        known.withColumn("before", F.lag("t").over(same))
        .withColumn("was", F.lag("s").over(order))
        .withColumn("next_t", F.lead("t").over(order))
        .withColumn(
            "new",
            F.when(
                F.col("was").isNull()
                | (hour("t") - hour("before") >= 14)
                | (F.col("was") != F.col("s")),
                1,
            ).otherwise(0),
        )
    )
    want = flagged.withColumn("session", F.sum("new").over(Window.partitionBy("k").orderBy("t")))
    columns = ["k", "t", "s", "next_t", "session"]
    assert rows(got, *columns) == rows(want, *columns)


def test_trailing_sums(unique):
    spec = {"sum": "v"}, {"_6": 5, "_12": 11}, "_24"
    got = trailing_sums(unique, "k", "t", *spec)
    want = trailing_sums_self_join(unique, "k", "t", *spec)
    columns = ["k", "t", "sum_24", "sum_6", "sum_12"]
    assert rows(got, *columns) == rows(want, *columns)


def test_trailing_sums_with_missing_values_and_narrow_blocks(spark):
    seen = {(r[0], r[1]): r for r in sample(900, 5)}
    log = spark.createDataFrame([(*r[:3], r[3] if r[3] % 4 else None, r[4]) for r in seen.values()], SCHEMA)
    spec = {"sum": "v"}, {"_2": 1}, "_full"
    for hours in (1, 3):
        got = trailing_sums(log, "k", "t", *spec, full_hours=hours, width=2 * HOUR)
        assert got.count() == len(seen)
        timed = log.where("k is not null and t is not null")
        # The plain form counts clock hours inside its range only.
        want = trailing_sums_self_join(timed, "k", "t", {"sum": "v"}, {"_2": 1} if hours > 1 else {}, "_full", hours)
        columns = ["k", "t", "sum_full"] + (["sum_2"] if hours > 1 else [])
        assert rows(got.where("k is not null and t is not null"), *columns) == rows(want, *columns)
        assert got.where("(k is null or t is null) and sum_full is not null").count() == 0


def test_trailing_sums_hold_no_sliding_frame(unique):
    plan = trailing_sums(unique, "k", "t", {"sum": "v"}, {"_6": 5}, "_24")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "RangeFrame, -82800000000" not in text


def test_rolling_max(spark):
    rnd = random.Random(5)
    data = [(k, h, rnd.choice([None, 0, 1, 2, 3, 4])) for k in (1, 2) for h in range(-24, 400)]
    df = spark.createDataFrame(data, "k long, hr int, a int")
    got = rolling_max_rows(df, "k", "hr", 24, ["a"], "_24", total="all", width=50)
    frame = Window.partitionBy("k").orderBy("hr").rowsBetween(-23, 0)
    want = df.withColumn("a_24", F.coalesce(F.max("a").over(frame), F.lit(0)))
    assert rows(got, "k", "hr", "a_24", "all") == rows(
        want.withColumn("all", F.col("a_24")), "k", "hr", "a_24", "all"
    )


def _first(left, right, key_of, fits):
    out = {}
    for r in left:
        hits = [key_of(x) for x in right if x.k is not None and x.k == r.k and fits(r, x)]
        out[(r.k, r.t)] = min(hits)[-1] if hits else None
    return out


def test_first_in_band(spark, log):
    left = spark.createDataFrame(sample(400, 7), SCHEMA)
    right = log.select(
        "k", "id", "v", F.coalesce(F.col("t"), F.lit(START).cast("timestamp_ntz")).cast("date").alias("d"),
        F.when(F.col("id") % 4 != 0, F.col("t")).alias("t"),
    )
    h = lambda n: dt.timedelta(hours=n)
    got = first_in_band(
        left, right, ["k"], "t",
        {"pre": hours_before(72), "post": hours_after(24), "near": around(48, 24)},
        F.struct("d", F.col("t").isNull().alias("u"), "t", "id"),
        "t", right_date="d", date_bands={"pre": (-3, 0), "post": (0, 1)},
    )
    result = {(r.k, r.t): r for r in got.collect()}
    lefts = [r for r in left.collect() if r.t is not None and r.k is not None]
    rights = right.collect()
    rank = lambda x: (x.d, x.t is None, x.t or START, x.id)

    def pre(a, x):
        if x.t is not None:
            return x.t < a.t <= x.t + h(72)
        return 0 <= (a.t.date() - x.d).days <= 3

    def post(a, x):
        if x.t is not None:
            return x.t - h(24) <= a.t < x.t
        return 0 <= (x.d - a.t.date()).days <= 1

    def near(a, x):
        return x.t is not None and a.t - h(48) <= x.t <= a.t + h(24)

    for name, fits in (("pre", pre), ("post", post), ("near", near)):
        want = _first(lefts, rights, rank, fits)
        have = {k: (r[name].id if r[name] else None) for k, r in result.items() if k[0] is not None}
        assert have == want, name


def test_band_needs_a_day(log):
    with pytest.raises(ValueError):
        first_in_band(log, log, ["k"], "t", {"x": (0, DAY - 1)}, F.struct("id"), "t")


@pytest.mark.parametrize("bounds", ["[)", "[]", "(]", "()"])
def test_point_in_interval(spark, log, bounds):
    spans = log.select(
        "k", F.col("id").alias("sid"), F.col("t").alias("a"),
        (F.col("t") + F.make_dt_interval(F.lit(0), (F.col("v") - 5).cast("int"))).alias("b"), "s",
    )
    points = spark.createDataFrame(sample(200, 11), SCHEMA).select("k", "t", "id")
    got = point_in_interval(
        points, spans, ["k"], "t", "a", "b", bounds, F.col("s") != "C", width=7 * HOUR
    )
    want = []
    spans_, points_ = spans.collect(), points.collect()
    for p in points_:
        hits = [
            x.sid for x in spans_
            if x.s != "C" and p.k is not None and p.k == x.k and p.t is not None and x.a is not None
            and (x.a <= p.t if bounds[0] == "[" else x.a < p.t)
            and (p.t <= x.b if bounds[1] == "]" else p.t < x.b)
        ]
        want += [(p.id, sid) for sid in hits] or [(p.id, None)]
    assert sorted(rows(got, "id", "sid"), key=str) == sorted(want, key=str)


def test_bucket_forms_agree(log):
    known = log.where("k is not null")
    grid = hour_grid(
        known.groupBy("k").agg(F.min("t").alias("a"), F.max("t").alias("b")), "k", "a", "b"
    )
    aggs = {"hi": ("max", "v"), "lo": ("min", "v")}
    one = bucket_agg(grid, known, "k", "t", aggs)
    two = bucket_agg_range_join(grid, known, "k", "t", aggs)
    columns = ["k", "hr", "endtime", "hi", "lo"]
    assert rows(one, *columns) == rows(two, *columns)


def test_star_forms_agree(log):
    grid = log.where("k is not null").select("k", "s").distinct().withColumn("g", F.lit(1))
    parts = [log.groupBy("k", "s").agg(F.max("v").alias("hi")),
             log.where("v > 48").groupBy("k", "s").agg(F.min("id").alias("lo"))]
    one = star_left(grid, parts, ["k", "s"])
    two = star_merge(
        grid, parts, ["k", "s"], [F.max("hi").alias("hi"), F.min("lo").alias("lo")]
    )
    assert rows(one, "k", "s", "g", "hi", "lo") == rows(two, "k", "s", "g", "hi", "lo")


def _far(spark):
    """Intervals of an hour, of months, and without a real end, beside points of three months."""
    spans = []
    for i in range(60):
        a = START + dt.timedelta(hours=37 * i)
        ends = [a + dt.timedelta(hours=1), a + dt.timedelta(days=16), a + dt.timedelta(days=300), dt.datetime(9999, 12, 31)]
        spans.append((1 + i % 3, i, dt.datetime(1900, 1, 1) if i % 10 == 9 else a, ends[i % 4]))
    points = [(1 + i % 4 if i % 9 else None, 1000 + i, START + dt.timedelta(minutes=311 * i) if i % 11 else None) for i in range(400)]
    return (
        spark.createDataFrame(points, "k long, id long, t timestamp_ntz"),
        spark.createDataFrame(spans, "k long, sid long, a timestamp_ntz, b timestamp_ntz"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("width", [DAY, 5 * HOUR])
def test_long_intervals(spark, how, width):
    points, spans = _far(spark)
    got = point_in_interval(points, spans, ["k"], "t", "a", "b", "[)", how=how, width=width)
    spans_, want = spans.collect(), []
    for p in points.collect():
        hits = [x.sid for x in spans_ if p.k is not None and p.k == x.k and p.t is not None and x.a <= p.t < x.b]
        want += [(p.id, sid) for sid in hits] or ([(p.id, None)] if how == "left" else [])
    assert sorted(rows(got, "id", "sid"), key=str) == sorted(want, key=str)


def test_an_endless_interval_costs_few_rows(spark):
    """No more cells than the radix, and no rows at blocks without points."""
    endless = spark.createDataFrame([(1, START, dt.datetime(9999, 12, 31))], "k long, a timestamp_ntz, b timestamp_ntz")
    first, last = chunks.block(micros("a"), DAY), chunks.block(micros("b"), DAY)
    assert endless.select(F.size(_cells(first, last))).first()[0] <= RADIX + 1
    points = spark.createDataFrame([(1, START + dt.timedelta(days=d)) for d in (0, 3, 40, 5000)] * 50, "k long, t timestamp_ntz")
    occupied = points.select("k", chunks.block(micros("t"), DAY).alias("_block")).distinct()
    assert listed(endless, ["k"], first, last, occupied).count() == 4
    plan = point_in_interval(points, endless, ["k"], "t", "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" not in plan


def test_endless_intervals_on_a_grid(spark):
    grid = spark.range(1, 200).select(F.lit(1).alias("k"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("endtime"))
    spans = [(1, dt.datetime(1800, 1, 1), dt.datetime(9999, 12, 31), 1), (1, START + dt.timedelta(minutes=90), START + dt.timedelta(hours=4), 2),
             (1, START + dt.timedelta(hours=199), dt.datetime(9999, 1, 1), 3), (2, START, START, 4)]
    df = spark.createDataFrame(spans, "k long, a timestamp_ntz, b timestamp_ntz, v int")
    got = interval_at_bucket_end(grid, df, "k", "a", "b", [F.max("v").alias("v"), F.count("v").alias("n")])
    for r in got.collect():
        hits = [v for k, a, b, v in spans if k == 1 and a < r.endtime <= b]
        assert (r.v, r.n) == (max(hits), len(hits))
