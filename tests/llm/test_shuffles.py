"""What is moved, and how often, where nothing is small enough to be broadcast."""

from __future__ import annotations

import re

import pytest

from vitalgrid.llm import ngram_join
from vitalgrid.llm.fingerprints import candidate_clusters, near_duplicate_classes
from vitalgrid.llm.ngram_join import ngram_classes

SETTINGS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def shuffled(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name in SETTINGS:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def moves(df, column: str) -> int:
    """Shuffles of the plan that carry a column."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return len(re.findall(rf"\) Exchange\nInput \[\d+\]: \[[^\n]*\b{column}#", text))


@pytest.mark.parametrize(
    ("classes", "name", "most"), [(near_duplicate_classes, "class_id", 1), (ngram_classes, "component_id", 2)]
)
def test_sets_are_moved_once_to_meet(spark, monkeypatch, shuffled, classes, name, most):
    seen, store = [], ngram_join.saved

    def saved(df, label="stage"):
        if label == "links":
            seen.append(moves(df, "grams"))
        return store(df, label)

    monkeypatch.setattr(ngram_join, "saved", saved)
    text = [" ".join(f"w{i * 1000 + k}" for k in range(120)) for i in range(30)]
    near = [t + " end" for t in text[::3]]
    docs = spark.createDataFrame(list(enumerate(text + near + near[:2])), "doc_id long, text string")
    found = {r[0]: r[1] for r in classes(docs).select("doc_id", name).collect()}
    expected = {i: i for i in range(30)} | {30 + k: 3 * k for k in range(10)} | {40: 0, 41: 3}
    assert found == expected
    assert seen == [most]


def test_copies_of_a_set_are_no_second_set(spark):
    """A set that stands in many rows shares its bands with itself only."""
    rows = [(bytes([k] * 16), [10 * k, 10 * k + 1]) for k in (1, 1, 1, 2, 3)] + [(bytes([4] * 16), [30, 77])]
    sets = spark.createDataFrame(rows, "sid binary, bands array<bigint>")
    found = candidate_clusters(sets).collect()
    assert {bytes(r.id)[0] for r in found} == {3, 4} and len(found) == 2
    assert len({r.component for r in found}) == 1
