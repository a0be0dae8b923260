"""Blocks of equal depth: one key holds nearly all rows of one day, many of them at one instant."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from vitalgrid.functions.time import DAY, HOUR
from vitalgrid.operators import chunks, ranking
from vitalgrid.operators.bands import around, first_in_band, hours_after, hours_before
from vitalgrid.operators.lookback import asof_lookback, prev_within
from vitalgrid.operators.sessions import gap_change_sessions

START = dt.datetime(2024, 1, 1)
SCHEMA = "k long, t timestamp_ntz, id long, v long, s string"
PARTS = 16


def hot(n: int, seed: int = 1):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        where = draw.random()
        t = START + dt.timedelta(days=3, seconds=draw.randrange(86_400))
        if where < 0.3:
            t = START + dt.timedelta(days=3, hours=5)
        elif where < 0.4:
            t = None
        elif where > 0.95:
            t = START + dt.timedelta(minutes=draw.randrange(12 * 24 * 60))
        out.append((1 if where < 0.93 else draw.choice([2, 3, None]), t, i, draw.randint(0, 9), draw.choice("ABC")))
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(hot(3000), SCHEMA).cache()


def plain(*order):
    return Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in order])


@pytest.mark.parametrize("alike", [False, True])
def test_the_largest_task_is_bounded(spark, alike):
    """Also where every row has the same key, time and ties."""
    data = [(1, START, 0, 0, "A")] * 8000 if alike else hot(8000)
    cut = chunks.equal_depth(spark.createDataFrame(data, SCHEMA), ["k"], ["t", "id"], PARTS)
    sizes = [r["count"] for r in cut.groupBy("k", "_block").count().collect()]
    assert sum(sizes) == 8000
    assert max(sizes) < 2 * 8000 / PARTS
    by_day = spark.createDataFrame(data, SCHEMA).groupBy("k", chunks.block_of("t", DAY)).count()
    assert by_day.agg(F.max("count")).first()[0] > 4000


def test_blocks_ascend_with_the_order(log):
    cut = chunks.equal_depth(log, ["k"], ["t", "id"], PARTS)
    limits = (
        cut.groupBy("k", "_block")
        .agg(F.min(chunks.sort_key(["t", "id"])).alias("a"), F.max(chunks.sort_key(["t", "id"])).alias("b"))
        .withColumn("before", F.lag("b").over(Window.partitionBy("k").orderBy("_block")))
    )
    assert limits.where("before > a").count() == 0


def test_neighbours_and_numbers(log):
    near = chunks.neighbours(log, ["k"], "t", ["id"], ["id"], "p", "n", width=None)
    w = plain("t", "id")
    want = log.select("id", F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("n"))
    assert rows(near, "id", "p.id", "n.id") == rows(want, "id", "p", "n")
    numbered = ranking.ordinal_within(log, ["k"], "t", ["id"], width=None)
    assert rows(numbered, "id", "rn") == rows(log.withColumn("rn", F.row_number().over(w)), "id", "rn")
    lagged = ranking.lag_or(log.withColumn("f", F.lit(START).cast("timestamp_ntz")), ["k"], "t", "f", "b", ["id"], width=None)
    want = log.withColumn("b", F.coalesce(F.lag("t").over(w), F.lit(START).cast("timestamp_ntz")))
    assert rows(lagged, "id", "b") == rows(want, "id", "b")


def test_running_total_shares_an_instant(log):
    got = chunks.running_total(log, ["k"], "t", "v", "total", width=None)
    assert rows(got, "id", "total") == rows(log.withColumn("total", F.sum("v").over(plain("t"))), "id", "total")


def test_sessions(log):
    columns = ["k", "t", "s", "next_t", "session"]
    got = gap_change_sessions(log, "k", "t", "s", 14, width=None)
    want = gap_change_sessions(log, "k", "t", "s", 14, width=DAY)
    assert rows(got, *columns) == rows(want, *columns)


def test_look_back(spark, log):
    got = prev_within(log, "k", "t", ["id"], 2 * HOUR, ties=["id"], width=None)
    want = prev_within(log, "k", "t", ["id"], 2 * HOUR, ties=["id"])
    assert rows(got, "id", "prev_id") == rows(want, "id", "prev_id")
    right = spark.createDataFrame(hot(500, 3), SCHEMA).groupBy("k", F.col("t").alias("rt")).agg(F.max("id").alias("rid"))
    got = asof_lookback(log, right, ["k"], "t", "rt", ["rid", "rt"], HOUR, width=None)
    want = asof_lookback(log, right, ["k"], "t", "rt", ["rid", "rt"], HOUR)
    assert rows(got, "id", "rid", "rt") == rows(want, "id", "rid", "rt")


def test_first_match_by_number(spark, log):
    left = spark.createDataFrame(hot(700, 7), SCHEMA)
    right = log.select(
        "k", "id", F.coalesce(F.col("t"), F.lit(START).cast("timestamp_ntz")).cast("date").alias("d"),
        F.when(F.col("id") % 4 != 0, F.col("t")).alias("t"),
    )
    call = lambda width: first_in_band(
        left, right, ["k"], "t", {"pre": hours_before(72), "post": hours_after(24), "near": around(48, 24)},
        F.struct("d", F.col("t").isNull().alias("u"), "t", "id"), "t", right_date="d",
        date_bands={"pre": (-3, 0), "post": (0, 1)}, width=width,
    )
    columns = ["k", "t", "pre.id", "post.id", "near.id"]
    got = call(None)
    assert rows(got, *columns) == rows(call(DAY), *columns)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "_day" not in plan.split("Window")[1].split("\n")[0]


def test_width_for(log):
    assert chunks.width_for(log, ["k"], "t", rows=10_000) == DAY
    assert chunks.width_for(log, ["k"], "t", rows=1_000) is None
    assert chunks.width_for(log.limit(0), ["k"], "t") == DAY
