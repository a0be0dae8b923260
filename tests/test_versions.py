"""Versions of tables: shared files, merges by key, compaction of small files, readers beside writers."""

from __future__ import annotations

import hashlib
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from vitalgrid.operators.quality import digests, table_diff
from vitalgrid.session import scratch_dir
from vitalgrid.sources import tables
from vitalgrid.sources.versions import VersionedTable

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("at", T.LongType())])


def table(spark, key=("k",)):
    return VersionedTable(spark, scratch_dir(spark, "versions"), SCHEMA, list(key))


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def paths(t, version=None):
    return {r.path for r in t.files(version).collect()}


def contents(path_list):
    return {p: hashlib.sha256(Path(p.removeprefix("file:")).read_bytes()).hexdigest() for p in path_list}


def test_merge_rewrites_only_files_that_hold_a_key(spark):
    t = table(spark)
    for low in (0, 1000, 2000):
        t.append(frame(spark, [(k, f"old {k}", 5) for k in range(low, low + 100)]).coalesce(1))
    before, bytes_before = paths(t), contents(paths(t))
    assert len(before) == 3
    new = [(1005, "newer", 6), (1005, "newest", 7), (1006, "older", 4), (1007, "as new", 5), (1500, "added", 1), (None, "no key", 1)]
    assert t.merge(frame(spark, new), "at") == 4
    shared = before & paths(t)
    assert len(shared) == 2 and contents(shared) == {p: bytes_before[p] for p in shared}
    got = {r.k: r.v for r in t.read().collect()}
    assert got[1005] == "newest" and got[1006] == "old 1006" and got[1007] == "old 1007"
    assert got[1500] == "added" and got[None] == "no key" and len(got) == 302
    assert {r.k: r.v for r in t.read(3).collect()}[1005] == "old 1005"  # the earlier version stands
    t.merge(frame(spark, [(None, "again", 2)]), "at")
    assert [r.v for r in t.read().where("k IS NULL").collect()] == ["again"]
    assert t.merge(frame(spark, []), "at") == 5


def test_merge_against_a_plain_form(spark):
    t = table(spark)
    old = [(k, f"a{k}", k % 7) for k in range(500)]
    t.replace(frame(spark, old).repartition(4))
    new = [(k, f"b{k}", (k * 3) % 7) for k in range(200, 900, 2)] + [(k, f"c{k}", 3) for k in range(200, 300)]
    t.merge(frame(spark, new), "at")
    want = {k: (at, v) for k, v, at in old}
    best = {}
    for k, v, at in new:
        best[k] = max(best.get(k, (at, v)), (at, v))
    for k, (at, v) in best.items():
        if k not in want or at > want[k][0]:
            want[k] = (at, v)
    assert {r.k: (r.at, r.v) for r in t.read().collect()} == want
    assert t.read().count() == len(want)


def test_compaction_leaves_large_files_alone(spark):
    t = table(spark)
    t.append(frame(spark, [(k, "x" * 50 + str(k * 7919), 1) for k in range(20_000)]).coalesce(1))
    large = paths(t)
    for low in range(0, 60, 10):
        t.append(frame(spark, [(k, "small", 1) for k in range(low, low + 10)][::-1]).coalesce(1))
    was, size = contents(large), t.files().agg(F.max("bytes")).first()[0]
    version = t.compact(target_bytes=size)
    assert len(paths(t)) == 2 and large <= paths(t) and contents(large) == was
    merged = (paths(t) - large).pop()
    assert [r.k for r in spark.read.parquet(merged).collect()] == list(range(60))  # the order is kept
    assert t.read().count() == 20_060
    assert t.compact(target_bytes=size) == version  # nothing left to do
    few = table(spark)
    few.append(frame(spark, [(1, "a", 1)]).coalesce(1))
    assert few.compact() == 1


def test_two_writers_cannot_take_one_version(spark):
    t = table(spark)
    t.append(frame(spark, [(1, "a", 1)]))
    files = t.files(1)
    t._commit(files, 1)
    with pytest.raises(RuntimeError):
        t._commit(files, 1)
    assert t.version() == 2


def test_a_reader_sees_old_or_new_rows(spark):
    first, second = spark.range(100), spark.range(100, 350)
    tables.load_table(spark, first, "swap_db", "t")
    begun = spark.table("swap_db.t")
    seen, errors, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add(spark.table("swap_db.t").count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(6):
        tables.load_table(spark, second if n % 2 == 0 else first, "swap_db", "t")
    done.set()
    reader.join()
    assert not errors and seen <= {100, 250}
    assert begun.count() == 100  # its files still stand
    assert tables.replace_and_verify(spark, second, "swap_db", "t") == 250
    assert tables.drop_old_versions(spark, "swap_db", "t", keep=2) == 6
    assert spark.table("swap_db.t").count() == 250
    tables.load_table(spark, second.withColumn("more", F.lit(1)), "swap_db", "t")
    assert spark.table("swap_db.t").columns == ["id", "more"]


def test_a_table_does_not_differ_from_itself(spark):
    data = [(None, "a", 1), (None, "a", 1), (None, None, None), (1, "x", 1), (1, "x", 1), (1, "y", 2), (2, None, 3)]
    t = frame(spark, data)
    assert table_diff(t, t.orderBy(F.desc("at")), ["k"]).count() == 0
    other = frame(spark, [*data[1:5], (1, "z", 2), (2, None, 4), (3, "n", 1)])
    got = rows(table_diff(t, other, ["k"], buckets=3), "k", "kind", "columns")
    assert sorted(got, key=str) == sorted(
        [(None, "only in first", None), (1, "changed", "v"), (2, "changed", "at"), (3, "only in second", None)], key=str
    )
    assert table_diff(t.limit(0), t.limit(0), ["k"]).count() == 0
    swapped = t.select("k", F.col("v"), F.when(F.col("k") == 1, 3 - F.col("at")).otherwise(F.col("at")).alias("at"))
    assert rows(table_diff(t, swapped, ["k"]), "k", "kind") == [(1, "changed")]


def test_digests_count_repeats(spark):
    one = frame(spark, [(1, "a", 1)])
    three = one.unionByName(one).unionByName(one)
    assert rows(digests(one, ["k"]), "n", "digest") != rows(digests(three, ["k"]), "n", "digest")
