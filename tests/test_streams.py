"""Streams in several micro-batches: late rows, alerts across batches, equality with batch."""

from __future__ import annotations

import datetime as dt
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from vitalgrid.session import scratch_dir
from vitalgrid.operators.bands import first_in_band, first_match, hours_after, hours_before
from vitalgrid.streaming.alert import STATE_STORE, early_alert, use_rocksdb
from vitalgrid.plans import scores as batch_scores
from vitalgrid.streaming import scores
from vitalgrid.streaming.matching import FirstMatch, stream_first_match
from vitalgrid.streaming.tables import batch_equals_stream, replay_stream, run_to_table, sink_append
from vitalgrid.streaming.windows import stream_range_join, windowed, with_event_time

SCHEMA = "k long, t timestamp_ntz, v int"


def put(spark, folder, name, data, schema=SCHEMA):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def drain(stream, folder):
    return run_to_table(stream, folder)


def test_late_rows_and_restart(spark):
    base = scratch_dir(spark, "late")
    put(spark, base, "src", [(1, at("10:10"), 1), (1, at("10:50"), 2), (1, at("14:00"), 3)])
    source = lambda: replay_stream(
        spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema
    )
    hours = lambda: windowed(
        source(), "t", "1 hour", "1 hour", ["k"], [F.sum("v").alias("v")]
    )
    first = drain(hours(), f"{base}/out")
    assert rows(first, "k", "v") == [(1, 3)]
    # Too late for the closed hour; a new hour closes; what was written is not repeated.
    spark.createDataFrame([(1, at("10:20"), 9), (1, at("18:00"), 4)], SCHEMA).write.mode(
        "append"
    ).parquet(f"{base}/src")
    second = drain(hours(), f"{base}/out")
    assert rows(second, "k", "v") == [(1, 3), (1, 3)]
    assert rows(second.where("v = 3"), "window_end") == [(at("11:00"),), (at("15:00"),)]


def test_batch_equality(spark):
    base = scratch_dir(spark, "equal")
    data = [(k, at(f"{1 + h // 24} {h % 24}:{m}"), h) for k in (1, 2) for h in range(30) for m in (5, 40)]
    put(spark, base, "src", data)
    stream = replay_stream(spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema)
    got = drain(
        windowed(stream, "t", "1 hour", "2 hours", ["k"], [F.count(F.lit(1)).alias("n")]),
        f"{base}/out",
    )
    batch = (
        spark.read.parquet(f"{base}/src")
        .groupBy("k", F.window(F.col("t").cast("timestamp"), "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("k", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
        .where(F.col("window_end") <= F.lit(at("2 03:40")))
    )
    assert batch.count() > 40
    assert batch_equals_stream(batch, got, ["k", "window_start"]).count() == 0
    off = batch.withColumn("n", F.col("n") + F.when(F.col("k") == 1, 1).otherwise(0))
    assert batch_equals_stream(off, got, ["k", "window_start"]).count() == batch.where("k = 1").count()


def test_alert_once_across_batches(spark):
    base = scratch_dir(spark, "alert")
    use_rocksdb(spark)
    schema = "k long, t timestamp_ntz, a int, b int"
    batches = [
        [(1, at("01:10"), 3, None), (2, at("01:10"), 3, None)],
        # Key 1 completes the total within 24 hours; key 2 a day later, too far apart.
        [(1, at("2 00:10"), None, 3), (2, at("2 01:10"), None, 3)],
        [(1, at("2 05:10"), 4, 4), (2, at("2 05:10"), 1, 3), (3, at("4 00:00"), 0, 0)],
    ]
    folder = f"{base}/src"
    result = None
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = replay_stream(spark, folder, spark.read.parquet(folder).schema)
        hourly = windowed(
            stream, "t", "1 hour", "1 hour", ["k"], [F.max("a").alias("a"), F.max("b").alias("b")]
        )
        result = drain(early_alert(hourly, "k", ["a", "b"], 6), f"{base}/out")
    assert rows(result, "k", "alert_time", "score") == [(1, at("2 01:00"), 6)]


def test_range_join_limits(spark):
    base = scratch_dir(spark, "pairs")
    put(spark, base, "ab", [(1, at("4 10:00"), 1), (1, at("2 09:00"), 2), (1, at("2 08:59:59"), 3)])
    put(spark, base, "cu", [(1, at("1 10:00"), 7), (1, at("3 09:00"), 8)])

    def side(name, prefix):
        schema = spark.read.parquet(f"{base}/{name}").schema
        rows_ = replay_stream(spark, f"{base}/{name}", schema)
        renamed = rows_.select(*[F.col(c).alias(prefix + c) for c in ("k", "t", "v")])
        return with_event_time(renamed, prefix + "t", "1 hour")

    pairs = stream_range_join(
        side("ab", "a"), side("cu", "c"), "ak", "ck", "at", "ct", "72 hours", "24 hours"
    )
    got = drain(pairs.select("av", "cv"), f"{base}/out")
    assert rows(got, "av", "cv") == [(1, 7), (1, 8), (2, 7), (3, 7)]


def test_sink_is_append_only(spark):
    base = scratch_dir(spark, "sink")
    put(spark, base, "src", [(1, at("10:00"), 1)])
    schema = spark.read.parquet(f"{base}/src").schema
    for _ in range(2):
        query = sink_append(replay_stream(spark, f"{base}/src", schema), f"{base}/out", f"{base}/ck")
        query.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 1


def test_folder_and_file_stream_alike(spark, tmp_path):
    frame = spark.range(100).selectExpr("id", "id % 7 AS kind")
    folder, single = str(tmp_path / "folder.parquet"), str(tmp_path / "one")
    frame.repartition(4).write.parquet(folder)
    frame.coalesce(1).write.parquet(single)
    file = next((tmp_path / "one").glob("*.parquet"))
    for path in (folder, str(file)):
        stream = replay_stream(spark, path, frame.schema, files_per_trigger=1)
        out = run_to_table(stream, scratch_dir(spark, "alike"))
        assert out.count() == 100
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        replay_stream(spark, str(tmp_path / "none"), frame.schema)


BANDS = {"before": hours_before(72), "after": hours_after(24)}
DATES = {"before": (-3, 0), "after": (0, 1)}


def test_first_match_over_batches_equals_batch(spark):
    """Rows arrive file by file within the allowed lateness; date-only cultures, unmatched orders."""
    use_rocksdb(spark)
    base, draw = scratch_dir(spark, "match"), random.Random(3)
    rows_ = []
    for i in range(700):
        t = at("00:00") + dt.timedelta(minutes=50 * i + draw.randrange(40))
        timed = draw.random() < 0.6
        lone = i % 40 == 0  # a key without cultures
        rows_.append((4 if lone else draw.choice([1, 2, 3, None]), i, lone or draw.randrange(4) == 0, t, t if timed else None))
    schema = "k long, id long, order boolean, t timestamp_ntz, ct timestamp_ntz"
    for n in range(0, 700, 100):
        part = rows_[n : n + 100]
        draw.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
        stream = replay_stream(spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema)
        got = drain(
            stream_first_match(
                stream.where("order"), stream.where("NOT order").select("k", F.col("id").alias("cid"), "ct", F.to_date("t").alias("d")),
                "k", "id", "t", "cid", "ct", BANDS, "1 hour", "d", DATES,
            ),
            f"{base}/out",
        )
    table = spark.read.parquet(f"{base}/src")
    orders = table.where("order AND k IS NOT NULL").select("k", "id", "t")
    cultures = table.where("NOT order").select("k", F.col("id").alias("cid"), "ct", F.to_date("t").alias("d"))
    rank = F.struct("d", F.col("ct").isNull().alias("u"), "ct", "cid")
    matches = first_in_band(orders, cultures, ["k"], "t", BANDS, rank, "ct", "d", DATES)
    want = first_match(orders, matches, ["k", "t"]).select("k", "id", "before.cid", F.col("after.cid").alias("aid"), "t")
    closed = want.where(F.col("t") < F.lit(rows_[-1][3] - dt.timedelta(days=4)))
    have = {r.id: (r.k, r.before, r.after) for r in got.collect()}
    assert got.count() == len(have)  # each order once
    assert closed.count() > 100
    for r in closed.collect():
        assert have[r.id] == (r.k, r.cid, r.aid)
    everything = {r.id: (r.k, r.cid, r.aid) for r in want.collect()}
    assert all(everything[i] == v for i, v in have.items())
    assert any(v[1] is None and v[2] is None for v in have.values())


def test_state_store_is_the_callers_choice(spark):
    before = spark.conf.get(STATE_STORE)
    spark.conf.unset(STATE_STORE)
    with pytest.raises(ValueError):
        early_alert(spark.range(1), "id", [], 1)
    spark.conf.set(STATE_STORE, before)


def test_points_agree_with_the_batch_columns(spark):
    draw = random.Random(1)
    names = ["pao2fio2ratio_vent", "pao2fio2ratio_novent", "rate_epinephrine", "rate_norepinephrine", "rate_dopamine",
             "rate_dobutamine", "meanbp_min", "gcs_min", "uo_24hr", "bilirubin_max", "creatinine_max", "platelet_min"]
    tops = [500, 500, 0.3, 0.3, 20, 20, 90, 15, 700, 15, 6, 200]
    data = [[None if draw.random() < 0.4 else float(round(draw.uniform(0, top), 0 if top > 1 else 2)) for top in tops] for _ in range(400)]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names))
    columns = [F.coalesce(points, F.lit(0)).alias(o) for o, points in batch_scores.organ_points().items()]
    for row, values in zip(df.select(*columns).collect(), data, strict=True):
        v = {n: x for n, x in zip(names, values, strict=True) if x is not None}
        v |= {short: v[n] for short, n in (("vent", names[0]), ("novent", names[1])) if n in v}
        assert tuple(row) == scores.organ_points(v), v


def score_events(spark, seed: int):
    """Readings, infusions and ventilation of three stays over five days; one stay stays open."""
    draw, out = random.Random(seed), []
    hours = lambda h: START_OF_STAY + dt.timedelta(hours=h)

    def event(key, kind, phase, ident, t, value):
        out.append((key, scores.KINDS.index(kind), phase, ident, int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 10**6, value, t))

    for key in (1, 2, 3):
        event(key, scores.STAY, 1, 0, hours(10 * key), 0.0)
        if key != 3:
            event(key, scores.STAY, 2, 0, hours(10 * key + 60.5), 0.0)
        for i in range(150):
            kind, top = draw.choice([("meanbp_min", 90), ("gcs_min", 15), ("platelet_min", 200), ("uo_24hr", 700),
                                     ("bilirubin_max", 9), ("creatinine_max", 5), ("pao2fio2ratio", 500)])
            event(key, kind, 0, 0, hours(draw.uniform(0, 110)).replace(microsecond=0), float(draw.randrange(top)))
        for i in range(8):
            kind, start = draw.choice(["rate_dopamine", "ventilated"]), hours(draw.uniform(0, 100)).replace(microsecond=0)
            event(key, kind, 1, i, start, 6.0)
            if i % 4:
                event(key, kind, 2, i, start + dt.timedelta(hours=draw.randrange(1, 30)), 6.0)
    return sorted(out, key=lambda e: e[-1])


START_OF_STAY = dt.datetime(2024, 3, 1)


def test_running_score_does_not_depend_on_batches(spark):
    use_rocksdb(spark)
    schema = "stay_id long, kind int, phase int, id long, t long, value double, at timestamp_ntz"
    events = score_events(spark, 5)
    found = []
    for size in (len(events), 90):
        base = scratch_dir(spark, "running")
        for n in range(0, len(events), size):
            spark.createDataFrame(events[n : n + size], schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
            stream = replay_stream(spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema)
            stream = stream.withColumn("at", F.col("at").cast("timestamp"))
            got = drain(scores.running_score([stream], "stay_id", "1 hour", threshold=8), f"{base}/out")
        found.append(sorted(tuple(r) for r in got.collect()))
    assert found[0] == found[1]
    hours = [r[:2] for r in found[0]]
    assert len(hours) == len(set(hours))
    assert {k: max(h for s, h in hours if s == k) for k in (1, 2)} == {1: 60, 2: 60}  # to the end of the stay
    assert max(h for s, h in hours if s == 3) > 60
    alerts = [r for r in found[0] if r[-1]]
    assert alerts and len({r[0] for r in alerts}) == len(alerts)
    assert all(r[-2] >= 8 for r in alerts)


def test_first_match_sets_one_timer_for_rows_that_come_together():
    """Rows that close later leave in time all the same: the timer moves on to the next of them."""
    hour = 3_600_000_000

    class Cell(list):
        get = list.__iter__
        appendList = list.extend

        def put(self, values):
            self[:] = values

    processor = FirstMatch("k", {"before": (-hour, 0), "after": (0, hour)}, {})
    processor.left, processor.right, timers = Cell(), Cell(), []
    processor.handle = SimpleNamespace(registerTimer=timers.append)
    left = [(0, n, n * hour, 0) for n in (3, 1, 2)]
    frame = pd.DataFrame([*left, (1, 9, 2 * hour - 1, 0)], columns=["side", "id", "t", "day"])
    assert list(processor.handleInputRows((7,), iter([frame]), None)) == []
    assert timers == [2 * 3_600_000]
    found = []
    while timers:
        now = timers.pop()
        for out in processor.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: now), None):
            found += [(now // 3_600_000, *map(int, r[:2]), *[None if pd.isna(x) else x for x in r[2:]]) for r in out.itertuples(index=False)]
    assert found == [(2, 7, 1, None, 9), (3, 7, 2, 9, None), (4, 7, 3, None, None)]


class Stored(list):
    """A list state or a value state that counts what is written to it."""

    written = 0

    def appendValue(self, value):
        self.written += 1
        self.append(value)

    def appendList(self, values):
        self.written += len(values)
        self.extend(values)

    def put(self, values):
        self.written += len(values)
        self[:] = values

    def update(self, value):
        self.written += 1
        self[:] = [value]

    def exists(self):
        return bool(self)


class StoredList(Stored):
    get = list.__iter__


class StoredValue(Stored):
    def get(self):
        return self[0] if self else None


def scored_alone(frames, watermarks, **options):
    """A stay's rows and what its state took: ``frames`` arrive one by one, a timer after each."""
    states, timers = [], []

    def state(kind):
        return lambda *_: states.append(kind()) or states[-1]

    processor = scores.RunningScore("k", 5, **options)
    processor.init(SimpleNamespace(getListState=state(StoredList), getValueState=state(StoredValue), registerTimer=timers.append))
    out = []
    for frame, now in zip(frames, watermarks, strict=True):
        assert list(processor.handleInputRows((7,), iter([frame]), None)) == []
        if min(timers) <= now:
            timers.clear()
            time = SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now)
            for rows_ in processor.handleExpiredTimer((7,), time, None):
                out += list(rows_.itertuples(index=False, name=None))
    return out, sum(s.written for s in states)


def one_stay(spark, n: int):
    names = ["kind", "phase", "id", "t", "value"]
    events = [e for e in score_events(spark, 5) if e[0] == 1]
    frame = pd.DataFrame([e[1:6] for e in events for _ in range(n)], columns=names)
    return [frame.iloc[: len(frame) // 2], frame.iloc[len(frame) // 2 :]], [int(frame["t"].iloc[len(frame) // 2 - 1]) // 1000, int(frame["t"].max()) // 1000]


def test_running_score_state_does_not_grow_with_calls(spark):
    """Events are stored packed: what the state is called for does not depend on their number."""
    few, many = scored_alone(*one_stay(spark, 1)), scored_alone(*one_stay(spark, 50))
    assert few[0] == many[0] and len(few[0]) == 61
    assert few[1] == many[1] <= 6


def test_running_score_in_pieces(spark, monkeypatch):
    whole, _ = scored_alone(*one_stay(spark, 1))
    monkeypatch.setattr(scores, "PIECE", 7)
    assert scored_alone(*one_stay(spark, 1))[0] == whole
    alerts, _ = scored_alone(*one_stay(spark, 1), alerts_only=True)
    assert alerts == [r for r in whole if r[-1] >> scores.BITS * 6] and len(alerts) == 1


def test_points_of_nan_agree_with_the_batch_columns(spark):
    """NaN is Spark's largest value; points of a stream and of a batch take it alike."""
    names = ["pao2fio2ratio_vent", "pao2fio2ratio_novent", "rate_epinephrine", "rate_norepinephrine", "rate_dopamine",
             "rate_dobutamine", "meanbp_min", "gcs_min", "uo_24hr", "bilirubin_max", "creatinine_max", "platelet_min"]
    data = [[float("nan") if i == j else None for i in range(len(names))] for j in range(len(names))]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names))
    columns = [F.coalesce(points, F.lit(0)).alias(o) for o, points in batch_scores.organ_points().items()]
    for row, values in zip(df.select(*columns).collect(), data, strict=True):
        v = {n: x for n, x in zip(names, values, strict=True) if x is not None}
        v |= {short: v[n] for short, n in (("vent", names[0]), ("novent", names[1])) if n in v}
        assert tuple(row) == scores.organ_points(v), v
