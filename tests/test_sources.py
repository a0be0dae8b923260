"""Reading, writing and maintaining tables."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import at, rows
from vitalgrid.operators import usage
from vitalgrid.plans.graph import build_models
from vitalgrid.session import scratch_dir, shuffle_partitions_for
from vitalgrid.sources import tables
from vitalgrid.sources.csv import ingest, ingest_all, read_csv_gz
from vitalgrid.sources.derived import bronze
from vitalgrid.sources.registry import SOURCES


def write_gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_registry_lists_all_tables():
    assert len(SOURCES) == 14
    assert {s.name for s in SOURCES.values() if s.large} == {"chartevents", "labevents", "nurse_charting"}
    clocks = [c for c in SOURCES["eicu.patient"].columns if c.endswith("time24")]
    assert len(clocks) == 4
    assert all(SOURCES["eicu.patient"].columns[c] == "string" for c in clocks)


def test_csv_types_order_and_extras(spark, tmp_path):
    write_gz(
        tmp_path / "icu/chartevents.csv.gz",
        "warning,itemid,value,valuenum,charttime,storetime,subject_id,hadm_id,stay_id,valueuom\n"
        '0,220045,080,80,2024-01-01 10:00:00,2024-01-01 10:05:00,1,2,3,bpm\n'
        '1,223900,"No Response-ETT, ""note"" ",NaN,2024-01-01 11:00:00,,1,2,3,\n'
        '1,223901, ,NA,2024-01-01 12:00:00,,1,2,3,\n'
        '1,223902,,,2024-01-01 13:00:00,,1,2,3,\n',
    )
    source = SOURCES["mimiciv.chartevents"]
    df = read_csv_gz(spark, str(tmp_path / source.path), source.schema, spread_by="stay_id")
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in source.schema.fields]
    assert rows(df, "itemid", "value", "valuenum", "charttime", "storetime") == [
        (220045, "080", 80.0, at("10:00"), at("10:05")),
        (223900, 'No Response-ETT, "note" ', None, at("11:00"), None),
        (223901, " ", None, at("12:00"), None),
        (223902, "", None, at("13:00"), None),  # no text is an empty text
    ]
    write_gz(tmp_path / "wide.csv.gz", "a,b\n1,2,3\n")
    with pytest.raises(Exception):
        read_csv_gz(
            spark, str(tmp_path / "wide.csv.gz"), T.StructType.fromDDL("a int, b int")
        ).collect()


def test_csv_override_and_missing_column(spark, tmp_path):
    write_gz(tmp_path / "a.csv.gz", "a,b\n07,1\n")
    schema = T.StructType.fromDDL("a int, b int")
    df = read_csv_gz(spark, str(tmp_path / "a.csv.gz"), schema, {"a": T.StringType()})
    assert rows(df, "a", "b") == [("07", 1)]
    with pytest.raises(ValueError, match="missing"):
        read_csv_gz(spark, str(tmp_path / "a.csv.gz"), T.StructType.fromDDL("c int"))


def test_ingest_replaces_only_when_complete(spark, tmp_path):
    path = tmp_path / "hosp/d_labitems.csv.gz"
    write_gz(path, "itemid,label\n1,a\n2,b\n")
    assert ingest(spark, "mimiciv.d_labitems", str(tmp_path), "db_ingest") == 2
    assert ingest(spark, "mimiciv.d_labitems", str(tmp_path), "db_ingest", "append") == 2
    assert spark.table("db_ingest.d_labitems").count() == 4
    assert ingest(spark, "mimiciv.d_labitems", str(tmp_path), "db_ingest") == 2
    write_gz(path, "itemid,label\nnot a number,a\n")
    with pytest.raises(Exception):
        ingest(spark, "mimiciv.d_labitems", str(tmp_path), "db_ingest")
    assert spark.table("db_ingest.d_labitems").count() == 2


def test_ingest_all(spark, tmp_path):
    for s in SOURCES.values():
        if s.dataset == "eicu":
            values = {"long": "1", "string": "> 89"}
            line = ",".join(values[k] for k in s.columns.values())
            write_gz(tmp_path / s.path, ",".join(s.columns) + "\n" + line + "\n")
    assert ingest_all(spark, {"eicu": str(tmp_path)}) == {
        "eicu.patient": 1, "eicu.diagnosis": 1, "eicu.nurse_charting": 1,
    }
    assert rows(spark.table("eicu.patient"), "age") == [("> 89",)]
    names = [r.tableName for r in tables.list_tables(spark, "eicu").collect()]
    assert names == ["diagnosis", "nurse_charting", "patient"]
    assert "eicu" in [r[0] for r in tables.list_tables(spark).collect()]


def test_ensure_and_verify(spark):
    schema = T.StructType.fromDDL("id int, name string")
    assert tables.ensure_table(spark, "db_poc", "sample", schema)
    assert not tables.ensure_table(spark, "db_poc", "sample", schema)
    df = spark.createDataFrame([(1, "alice"), (2, "bob"), (3, "carol")], schema)
    assert tables.replace_and_verify(spark, df, "db_poc", "sample") == 3
    assert tables.replace_and_verify(spark, df.limit(2), "db_poc", "sample") == 2
    with pytest.raises(ValueError):
        tables.load_table(spark, df, "db_poc", "sample", "merge")


def test_tagged_append(spark):
    path = scratch_dir(spark, "tag")
    df = spark.createDataFrame([(1, "alice")], "id int, name string")
    tables.append_tagged(df, path, "batch-a")
    tables.append_tagged(df, path, "batch-b")
    assert rows(spark.read.parquet(path), "id", "src") == [(1, "batch-a"), (1, "batch-b")]


def test_upsert(spark):
    schema = "id int, label string"
    target = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    source = spark.createDataFrame([(2, "late"), (3, "c")], schema)
    assert rows(tables.upsert_incremental(target, source, "id", "id"), "id", "label") == [
        (1, "a"), (2, "b"), (3, "c"),
    ]
    empty = target.limit(0)
    assert tables.upsert_incremental(empty, source, "id", "id").count() == 2
    stamped = "id int, label string, at int"
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], stamped)
    source = spark.createDataFrame([(1, "new", 6), (2, "old", 5)], stamped)
    merged = tables.upsert_incremental(target, source, "id", "at")
    assert rows(merged, "id", "label") == [(1, "new"), (2, "b")]


def test_comments_survive(spark):
    df = tables.with_comments(spark.range(1).withColumn("v", F.lit(1)), {"v": "a value"})
    tables.replace_table(spark, df, "db_notes", "t")
    notes = {r.col_name: r.comment for r in spark.sql("DESCRIBE db_notes.t").collect()}
    assert notes["v"] == "a value" and notes["id"] is None


def test_build_models_writes_parents(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    built = build_models(
        spark,
        bronze(events),
        ["icustay_hourly", "urine_output"],
        "db_models",
        {"icustay_hourly": {"hr": "hours since admission"}},
    )
    notes = {r.col_name: r.comment for r in spark.sql("DESCRIBE db_models.icustay_hourly").collect()}
    assert notes["hr"] == "hours since admission"
    assert list(built) and set(built) == {"icustay_times", "icustay_hourly", "urine_output"}
    assert spark.table("db_models.icustay_hourly").count() == built["icustay_hourly"].count() > 0


def test_usage_lines(spark, tmp_path):
    def line(request, tokens, model="m1", **cache):
        usage_ = {"input_tokens": tokens, "output_tokens": 1, **cache}
        return json.dumps({"requestId": request, "message": {"model": model, "usage": usage_}})

    root = tmp_path / "logs"
    (root / "s1" / "deep").mkdir(parents=True)
    (root / "s1.jsonl").write_text(
        "\n".join(
            [
                line("r1", 10), line("r1", 99), line(None, 5), line(None, 5), "{broken",
                json.dumps({"requestId": "x", "message": {"model": "m1"}}),
                json.dumps({"requestId": "y", "message": "text"}), "",
                line("r2", 7, "m2", cache_creation_input_tokens=8),
            ]
        )
    )
    (root / "s1" / "deep" / "a.jsonl").write_text(
        line("r3", 100, cache_creation={"ephemeral_5m_input_tokens": 4}, cache_creation_input_tokens=4)
        + "\n" + line("r4", 1, usage.SYNTHETIC)
    )
    lines = usage.read_usage_lines(spark, str(root))
    assert usage.malformed_lines(lines).collect()[0][0] == 1
    prices = spark.createDataFrame(
        [("m1", 2.0, 10.0)], "model string, input_price double, output_price double"
    )
    got = usage.usage_rollup(usage.usage_records(lines), prices, top=5)
    result = {(r.dimension, r.name): r for r in got.collect()}
    m1, m2 = result["model", "m1"], result["model", "m2"]
    assert m1.requests == 4 and m1.cache_write_5m == 4
    assert m1.input == 10 + 5 + 5 + 100  # the first line of r1
    assert m2.cost is None and m2.cache_write_1h == 8  # no price is not free
    assert ("model", usage.SYNTHETIC) not in result
    assert result["scope", "sub"].requests == 1 and result["scope", "main"].requests == 4
    assert result["session", "s1"].requests == 5
    sub = (100 * 2 + 1 * 10 + 4 * 2 * 1.25) / 1e6
    assert result["scope", "sub"].cost == pytest.approx(sub)


def test_partition_rule():
    assert shuffle_partitions_for(100 * 2**40, 4000) == 100 * 2**40 // (128 * 2**20)
    assert shuffle_partitions_for(1, 8) == 8


def test_upsert_keeps_one_row_per_key(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, at int, v string")
    new = spark.createDataFrame([(2, 3, "c"), (2, 4, "d"), (3, 2, "e"), (1, 1, "late")], "k int, at int, v string")
    got = sorted(tuple(r) for r in tables.upsert_incremental(old, new, "k", "at").collect())
    assert got == [(1, 1, "a"), (2, 4, "d"), (3, 2, "e")]


def test_csv_files_of_another_column_order_fail(spark, tmp_path):
    (tmp_path / "1.csv").write_text("x,y\n1,10\n")
    (tmp_path / "2.csv").write_text("y,x\n20,2\n")
    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])
    with pytest.raises(Exception, match="header|schema"):
        read_csv_gz(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")], schema).collect()
