from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from vitalgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[8]",
        "tests",
        shuffle_partitions=4,
        extra={
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "scratch"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """'10:30', '2 10:30' (day 2) or '10:30:01' as a time in January 2024."""
    day, _, clock = text.rpartition(" ")
    parts = [int(p) for p in clock.split(":")]
    return dt.datetime(2024, 1, int(day or 1), *parts)


def rows(df, *columns):
    return sorted(
        (tuple(r) for r in df.select(*columns).collect()),
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )
