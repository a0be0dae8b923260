"""Rows that repeat are documents of their own in the mix."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.llm.mixing import mix_sources, with_copies

SCHEMA = "doc_id long, text string, source string, size string, copy_ string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def test_a_repeated_row_is_taken_in_part(spark):
    """Two sources of the same size, the first one row 200 times: a third of all words is 1333."""
    rows = [(1, "ten words stand in this text and they are ten", "a")] * 200
    rows += [(i, " ".join(["word"] * 10), "b") for i in range(10, 210)]
    mixed = mix_sources(frame(spark, rows).repartition(7))
    assert mixed.count() == 400
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 10, r
    assert mixed.where("taken > 3 * size").count() == 0
    again = mix_sources(frame(spark, rows).repartition(3))
    sums = [sorted(tuple(r) for r in m.groupBy("doc_id").agg(F.sum("taken")).collect()) for m in (mixed, again)]
    assert sums[0] == sums[1]


def test_copies_are_numbered_without_gaps(spark):
    rows = [(1, "a", "s")] * 30 + [(None, None, None)] * 5 + [(2, "a", "s"), (1, "b", "s")]
    got = with_copies(frame(spark, rows).drop("copy_").repartition(6))
    numbers: dict = {}
    for r in got.collect():
        numbers.setdefault((r.doc_id, r.text), []).append(r.copy_)
    assert {k: sorted(v) for k, v in numbers.items()} == {
        (1, "a"): list(range(1, 31)), (None, None): list(range(1, 6)), (2, "a"): [1], (1, "b"): [1],
    }


def test_null_rows_and_no_rows(spark):
    assert mix_sources(frame(spark, [])).count() == 0
    assert mix_sources(frame(spark, [(None, None, None)] * 3 + [(1, "", "a")])).count() == 4
