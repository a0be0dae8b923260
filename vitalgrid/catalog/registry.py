"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.session import apply_contract


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


class Source:
    """The tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_contract(spark)
        self.folder = folder.rstrip("/")

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of ``Source`` under a name."""

    def register(fn: Callable[[Source], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Source(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = Query(run, sql)
        return fn

    return register
