"""Compare a Spark result with a DuckDB result, ignoring row order, by column name."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def assert_same(df, con, sql: str) -> int:
    got = normal([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normal(cur.fetchall(), names)
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, f"{len(bad)} rows differ, first: {sorted(names)}\n{bad[0][0]}\n{bad[0][1]}"
    return len(got)
