"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from vitalgrid.functions.time import shift
from vitalgrid.operators import ranking
from vitalgrid.operators.intervals import point_in_interval
from vitalgrid.operators.rolling import TASK_ROWS, trailing_sums, trailing_sums_self_join
from conftest import at, rows
from vitalgrid.operators.bands import around, first_in_band
from vitalgrid.operators.chunks import with_halo
from vitalgrid.operators.grid import as_runs, grown, hour_grid, hour_runs
from vitalgrid.functions.time import index
from vitalgrid.plans import scores
from vitalgrid.plans.graph import MODELS, Tables, item_groups
from vitalgrid.catalog.models import tables_for
from vitalgrid.catalog.registry import Source
from vitalgrid.session import MANY_SIDES, MEASURED, apply_contract, bytes_of, freed_shuffles, scratch_dir
from vitalgrid.sources.derived import bronze
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SERIES = [
    "grid_bucket_max", "asof_lookback", "prev_within_6h", "rolling_24h", "first_match_band",
    "window_join_48_24", "gap_change_sessions", "point_in_interval", "rolling_max_24rows",
    "interval_at_bucket_end", "star_left", "upsert_incremental", "usage_rollup", "table_diff",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SERIES)
def test_no_nested_loops(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", list(MODELS))
def test_models_have_no_nested_loops(spark, name):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(Tables(bronze(events))[name])
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", ["prev_within_6h", "rolling_24h", "gap_change_sessions"])
def test_windows_are_cut_by_block(spark, name):
    """No shuffle sends raw rows by key alone."""
    plan = plan_of(entry_points.queries()[name](spark, SF))
    windows = [line for line in plan.splitlines() if " Window [" in line or line.strip().startswith("Window [")]
    assert windows
    raw = [w for w in windows if "_block" not in w.split("specifiedwindowframe")[-1]]
    assert all("_tail" in w or "_head" in w or "_openings" in w for w in raw)


def test_filters_and_columns_reach_the_scan(spark):
    path = scratch_dir(spark, "scan")
    events = spark.read.parquet(f"{SF}/events.parquet")
    bronze(events)["chartevents"].write.parquet(path)
    t = Tables({"chartevents": spark.read.parquet(path)})
    plan = plan_of(t.narrow("vitalsign", ("mbp",)))
    assert "In(itemid, [220052,220181,225312])" in plan
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "storetime" not in schema and "value:" not in schema


def test_ranking_prunes_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(ranking.top_per_group(df, ["user_id"], [F.col("ts")], 3))
    assert plan.count("WindowGroupLimit") == 2  # one of them below the exchange
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_score_reads_each_event_table_once(spark, tmp_path):
    """The raw chart and lab tables are scanned by one write each; all readers take its parts."""
    raw = bronze(spark.read.parquet(f"{SF}/events.parquet"))
    for name in ("chartevents", "labevents"):
        raw[name].write.parquet(str(tmp_path / f"raw_{name}"))
        raw[name] = spark.read.parquet(str(tmp_path / f"raw_{name}"))
    tables = Tables(raw, str(tmp_path / "store"))
    tables.prepare("sofa")
    assert tables["sofa"].columns and len(tables.built()) > 10
    for frame in tables.built().values():
        assert not any("/raw_" in f for f in frame.inputFiles())
    assert any("chartevents_by_item" in f for f in tables["sofa"].inputFiles())


def test_parts_hold_what_readers_ask_for(spark, tmp_path):
    raw = bronze(spark.read.parquet(f"{SF}/events.parquet"))
    tables = Tables(raw, str(tmp_path / "store"))
    tables.part(["gcs", "bg", "icustay_times", "urine_output_rate"])
    groups = item_groups("chartevents", ["gcs", "bg", "icustay_times", "urine_output_rate"])
    assert len(set(groups.values())) == 3
    for codes in ([220045], [220739, 223900, 223901], [223835, 220045]):
        whole = raw["chartevents"].where(F.col("itemid").isin(codes))
        assert tables.readings("chartevents", codes).columns == whole.columns
        assert rows(tables.readings("chartevents", codes), *whole.columns) == rows(whole, *whole.columns)
    other = tables.readings("chartevents", [220277])  # in no part: read from the table itself
    assert other.count() == raw["chartevents"].where("itemid = 220277").count()
    assert item_groups("labevents", ["bg"]) == {}


def test_only_measured_sides_are_broadcast(spark, tmp_path):
    """Intervals in a small file that lists each at ten blocks: no guess broadcasts them."""
    apply_contract(spark)
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 1000 * 60).cast("timestamp_ntz")
    spark.range(20000).select((F.col("id") % 50).alias("k"), at.alias("a"), shift("a", days=9).alias("b")).write.parquet(
        str(tmp_path / "spans")
    )
    spark.range(3000).select((F.col("id") % 50).alias("k"), at.alias("t")).write.parquet(str(tmp_path / "points"))
    spans, points = spark.read.parquet(str(tmp_path / "spans")), spark.read.parquet(str(tmp_path / "points"))
    met = point_in_interval(points, spans, ["k"], "t", "a", "b")
    assert "BroadcastHashJoin" not in plan_of(met)
    inside = (F.col("p.k") == F.col("s.k")) & (F.col("a") <= F.col("t")) & (F.col("t") < F.col("b"))
    plain = points.alias("p").join(spans.alias("s"), inside, "left")
    assert met.count() == plain.count()


def test_a_side_measured_small_is_broadcast(spark):
    apply_contract(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    few = spark.range(10).groupBy("id").count()
    joined = spark.range(100000).join(few, "id")
    assert joined.count() == 10
    joined.collect()
    assert "BroadcastHashJoin" in plan_of(joined)


def test_trailing_sums_sort_twice_and_spread_by_rows(spark):
    """Two sorts above the shuffle, and tasks that grow with the rows, not with Spark's merging."""
    df = spark.range(1000).select(
        (F.col("id") % 7).alias("k"), shift(F.lit("2024-01-01").cast("timestamp_ntz"), minutes=F.col("id")).alias("t"), "id"
    )
    few = max(spark.sparkContext.defaultParallelism, 1)
    sums = {n: trailing_sums(df, "k", "t", {"n": "id"}, {"_6": 5}, "_24", rows=n) for n in (1000, 40 * TASK_ROWS)}
    plan = plan_of(sums[40 * TASK_ROWS])
    assert plan.split("Exchange")[0].count("Sort [") == 2
    assert "_block" in plan.split("Exchange hashpartitioning(")[1] and ", 40), REPARTITION_BY_NUM" in plan
    assert f", {few}), REPARTITION_BY_NUM" in plan_of(sums[1000])
    plain = trailing_sums_self_join(df, "k", "t", {"n": "id"}, {"_6": 5}, "_24")
    columns = ["k", "t", "n_24", "n_6"]
    assert rows(sums[40 * TASK_ROWS], *columns) == rows(plain, *columns)


def test_models_broadcast_small_sides_only(spark):
    """A side of 1.6 MB, below the session's threshold: a plan of the models does not broadcast it, a
    query that follows does."""

    def joined():
        side = spark.range(100000).groupBy("id").count()
        both = spark.range(200000).join(side, "id")
        assert both.count() == 100000
        both.collect()
        return plan_of(both)

    own = bytes_of(spark.conf.get(MEASURED))
    tables_for(Source(spark, SF), "icustay_hourly")
    assert bytes_of(spark.conf.get(MEASURED)) == MANY_SIDES < own
    assert "BroadcastHashJoin" not in joined()
    Source(spark, SF)
    assert bytes_of(spark.conf.get(MEASURED)) == own
    assert "BroadcastHashJoin" in joined()


@pytest.mark.parametrize("text, size", [("10485760b", 10 << 20), ("256k", 256 << 10), ("10MB", 10 << 20), ("-1", -1), ("7", 7)])
def test_sizes_as_settings_write_them(text, size):
    assert bytes_of(text) == size


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}


def test_scores_move_once_and_their_grid_not_at_all(spark):
    """Aggregate, growth of the grid and windows lie above one shuffle, which deals by (stay, block)."""
    plan = plan_of(Tables(bronze(spark.read.parquet(f"{SF}/events.parquet")))["sofa"])
    top, below = plan.split("Exchange", 1)
    assert "Window [" in top and "Aggregate(" in top and "Generate explode" in top
    assert "_block" in below.splitlines()[0] and "REPARTITION_BY_NUM" in below.splitlines()[0]


def test_scores_near_a_suspicion_are_found_where_they_lie(spark):
    """The join sends suspicions to the blocks of the scores; limits are included."""
    t = Tables(bronze(spark.read.parquet(f"{SF}/events.parquet")))
    hours = t.scored_hours(scores.BLOCK)
    some = spark.createDataFrame([(30000001, at("9 10:00")), (30000002, at("1 00:00"))], "stay_id long, suspected_infection_time timestamp_ntz")
    near = scores.within_reach(hours, some, 48, 24)
    top, below = plan_of(near).split("Exchange", 1)
    assert "SortMergeJoin [stay_id" in top and "Window [" in top and "REPARTITION_BY_NUM" in below.splitlines()[0]
    inside = "stay_id = 30000001 AND endtime BETWEEN TIMESTAMP_NTZ'2024-01-07 10:00:00' AND TIMESTAMP_NTZ'2024-01-10 10:00:00'"
    first = "stay_id = 30000002 AND endtime BETWEEN TIMESTAMP_NTZ'2023-12-30 00:00:00' AND TIMESTAMP_NTZ'2024-01-02 00:00:00'"
    want = hours.where(f"({inside}) OR ({first})").drop("_block")
    found = rows(near, "stay_id", "endtime")
    assert found and found == rows(want, "stay_id", "endtime")


def test_unique_candidates_need_no_reduction(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    left = events.where("event_type = 'error'").select("user_id", F.col("ts").alias("t"))
    right = events.where("event_type = 'view'").select("user_id", "ts", "event_id")
    found = [
        first_in_band(left, right, ["user_id"], "t", {"near": around(48, 24)}, F.struct("ts", "event_id"), "ts", unique=unique)
        for unique in (False, True)
    ]
    columns = ["user_id", "t", "near.event_id"]
    assert rows(found[0], *columns) == rows(found[1], *columns)
    assert plan_of(found[1]).count("Exchange hash") < plan_of(found[0]).count("Exchange hash")


@pytest.mark.parametrize("width, reach", [(240, 23), (7, 3), (5, 12)])
def test_runs_grow_to_the_grid_with_its_halo(spark, width, reach):
    data = [(1, at("08:10"), at("4 09:00")), (2, at("2 00:00"), at("2 00:00")), (3, at("5 10:00"), at("5 09:00")), (4, None, None)]
    bounds = spark.createDataFrame(data, "k long, a timestamp_ntz, b timestamp_ntz")
    grid = hour_grid(bounds, "k", "a", "b")
    assert grid.count() == (73 + 25) + 25
    placed = with_halo(grid, index("endtime", "hour"), width, reach)
    # A block behind the last hour holds nothing but copies: no run is made for it.
    used = placed.where("_own").select("k", "_block").distinct()
    columns = ["k", "_block", "hr", "endtime"]
    runs = grown(hour_runs(bounds, "k", "a", "b", 24, width, reach))
    assert rows(runs, *columns) == rows(placed.join(used, ["k", "_block"]), *columns)
    assert rows(grown(as_runs(grid, "k", width, reach)), *columns) == rows(placed, *columns)


def test_scores_over_a_built_grid(spark):
    """The grid read as a table, as ``build_models`` has it, gives the rows of one that grows."""
    raw = bronze(spark.read.parquet(f"{SF}/events.parquet"))
    built = Tables({**raw, "icustay_hourly": Tables(raw)["icustay_hourly"]})["sofa"]
    columns = ["stay_id", "hr", "endtime", "renal", "sofa_24hours"]
    assert rows(built, *columns) == rows(Tables(raw)["sofa"], *columns)


def test_parts_are_written_without_a_shuffle(spark, tmp_path):
    tables = Tables(bronze(spark.read.parquet(f"{SF}/events.parquet")), str(tmp_path / "store"))
    before = shuffle_files(spark)
    tables.part(["gcs", "bg", "chemistry", "icustay_times", "urine_output_rate"])
    assert shuffle_files(spark) <= before


def test_shuffles_of_a_finished_write_are_freed(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before = spark.conf.get(key, None), shuffle_files(spark)
    with freed_shuffles(spark):
        spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(str(tmp_path / "t"))
    assert shuffle_files(spark) <= before
    assert spark.conf.get(key, None) == own
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7
