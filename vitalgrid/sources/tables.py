"""Tables: existence, loads, appends, keyed upserts, comments, listing. ``versions`` has compaction
and merges in place."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def ensure_table(spark: SparkSession, database: str, table: str, schema: T.StructType) -> bool:
    """Create an empty Parquet table unless it exists. True when it was created."""
    ensure_database(spark, database)
    name = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return True


def load_table(
    spark: SparkSession, df: DataFrame, database: str, table: str, mode: str = "replace"
) -> int:
    """Write a whole table in one job and return the rows written, counted while writing.

    A replacing load writes a new folder and then points the table to it, one catalog step: a reader
    sees the old rows or the new ones, and one that has begun goes on with the old files, which stay
    until ``drop_old_versions``. A load that fails while writing changes nothing. Only where the
    columns change, the table is dropped and made anew.
    """
    ensure_database(spark, database)
    name = f"`{database}`.`{table}`"
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("n"))
    if mode == "append":
        rows.write.format("parquet").mode("append").saveAsTable(name)
    elif mode == "replace":
        location = f"{versions_folder(spark, database, table)}/{uuid.uuid4().hex}"
        rows.write.parquet(location)
        fields = [(f.name, f.dataType, f.metadata) for f in df.schema.fields]
        exists = spark.catalog.tableExists(name)
        if exists and [(f.name, f.dataType, f.metadata) for f in spark.table(name).schema.fields] == fields:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(name)
        else:
            if exists:
                spark.sql(f"DROP TABLE {name}")
            spark.catalog.createTable(name, path=location, source="parquet", schema=df.schema)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return counted.get["n"]


def versions_folder(spark: SparkSession, database: str, table: str) -> str:
    """Where the versions of a table lie: below the database's folder, one folder each."""
    found = spark.sql(f"DESCRIBE DATABASE `{database}`").where("info_name = 'Location'").first()
    return f"{found[1].rstrip('/')}/{table}__versions"


def drop_old_versions(spark: SparkSession, database: str, table: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` folders of a table, never the one it points to."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(versions_folder(spark, database, table))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    described = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{table}`").where("col_name = 'Location'").first()
    current = described[1].rstrip("/").rsplit("/", 1)[1]
    found = sorted(fs.listStatus(root), key=lambda f: -f.getModificationTime())
    old = [f.getPath() for f in found[keep:] if f.getPath().getName() != current]
    for path in old:
        fs.delete(path, True)
    return len(old)


def replace_table(spark: SparkSession, df: DataFrame, database: str, table: str) -> DataFrame:
    load_table(spark, df, database, table, "replace")
    return spark.table(f"`{database}`.`{table}`")


def replace_and_verify(spark: SparkSession, df: DataFrame, database: str, table: str) -> int:
    """Replace a table and read the count back from storage; both counts must agree."""
    written = load_table(spark, df, database, table, "replace")
    stored = spark.table(f"`{database}`.`{table}`").count()
    if stored != written:
        raise RuntimeError(f"{database}.{table}: wrote {written} rows, found {stored}")
    return stored


def append_tagged(df: DataFrame, path: str, tag: str, column: str = "src") -> None:
    """Append rows with a literal column that says who wrote them."""
    df.withColumn(column, F.lit(tag)).write.mode("append").parquet(path)


def upsert_incremental(
    target: DataFrame, source: DataFrame, key: str | Sequence[str], watermark: str
) -> DataFrame:
    """The target after merging source rows above its highest watermark value, by key.

    The maximum is a scalar subquery. Of source rows with one key the one with the highest
    watermark wins, ties by the other columns; null keys are one key. Write the result to a new
    version of the table: it reads the old one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    high = target.agg(F.max(watermark).alias("high")).scalar()
    new = source.where(high.isNull() | (F.col(watermark) > high)).select(*target.columns)
    others = [c for c in target.columns if c not in (watermark, *keys)]
    best = F.max(F.struct(F.col(watermark).alias("high"), F.struct(*others).alias("row") if others else F.lit(0)))
    latest = new.groupBy(*keys).agg(best.alias("latest"))
    mark = [] if watermark in keys else [F.col("latest.high").alias(watermark)]
    rest = [F.col(f"latest.row.{c}").alias(c) for c in others]
    new = latest.select(*keys, *mark, *rest).select(*target.columns)
    marked = new.select(*(F.col(k).alias(f"new_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in keys]
    return target.join(marked, same, "left_anti").unionByName(new)


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """A bounded look at a table; safe to bring to the driver."""
    return df.limit(n)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Databases, or the tables of one."""
    if database is None:
        return spark.sql("SHOW NAMESPACES")
    return spark.sql(f"SHOW TABLES IN `{database}`")


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they are stored with the table when it is written."""
    return df.select(
        *[
            F.col(f.name).alias(f.name, metadata={**f.metadata, "comment": comments[f.name]})
            if f.name in comments
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
