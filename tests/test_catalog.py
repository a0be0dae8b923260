"""Every registered query against its SQL, on the smallest data set."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from compare import assert_same, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF)
    if name in SQL:
        assert_same(result, con, SQL[name])
    else:
        assert result.count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["user_id", "endtime", "hr", "value_max", "value_min", "n_events"]
    assert df.count() > 0
