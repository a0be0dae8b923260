"""Loads, appends, upserts and compaction of the test tables, through real files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vitalgrid.catalog.bronze_sql import BRONZE
from vitalgrid.catalog.registry import query
from vitalgrid.operators.relational import limit
from vitalgrid.session import scratch_dir
from vitalgrid.sources import tables
from vitalgrid.sources.csv import FORMAT, ingest, read_csv_gz
from vitalgrid.sources.derived import bronze
from vitalgrid.sources.versions import VersionedTable


@query("csv_gz_roundtrip", "select * from orders")
def _(s):
    orders, folder = s["orders"], scratch_dir(s.spark, "csv")
    orders.write.options(**FORMAT).option("compression", "gzip").csv(folder)
    return read_csv_gz(s.spark, folder, orders.schema, spread_by="o_orderkey")


@query("bronze_ingest", BRONZE["chartevents"])
def _(s):
    """A large raw table: gzip CSV, columns by header, declared types, table, count check."""
    folder, database = scratch_dir(s.spark, "ingest"), f"ingest_{uuid.uuid4().hex[:12]}"
    rows = bronze(s["events"])["chartevents"].withColumn("valueuom", F.lit(None).cast("string"))
    writer = rows.write.options(**FORMAT).option("compression", "gzip")
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(
        f"{folder}/icu/chartevents.csv.gz"
    )
    written = ingest(s.spark, "mimiciv.chartevents", folder, database)
    stored = s.spark.table(f"{database}.chartevents")
    if stored.count() != written:
        raise RuntimeError("the table does not hold the rows that were written")
    return stored.drop("valueuom")


@query("compaction_roundtrip", "select * from events")
def _(s):
    """Small files become one, large ones stay: the table is one large and twelve small files."""
    events, folder = s["events"], scratch_dir(s.spark, "compact")
    recent = F.col("event_id") % 13 == 0
    events.where(~recent).coalesce(1).sortWithinPartitions("event_id").write.parquet(f"{folder}/large")
    events.where(recent).repartition(12).write.parquet(f"{folder}/small")
    t = VersionedTable(s.spark, f"{folder}/table", events.schema, ["event_id"])
    t.adopt(f"{folder}/large")
    t.adopt(f"{folder}/small")
    large = t.files().agg(F.max("bytes")).first()[0]
    t.compact(target_bytes=large)
    before, after = ({r.path for r in t.files(v).collect()} for v in (2, 3))
    if len(before) != 13 or len(after) != 2 or len(before & after) != 1:
        raise RuntimeError("compaction did not join exactly the small files")
    return t.read()


@query(
    "merge_versions",
    """
select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderkey % 20 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
  case when o_orderkey % 20 = 0 then o_orderdate + interval 1 day else o_orderdate end as o_orderdate,
  o_orderpriority
from (select * from orders where o_orderkey <= (select max(o_orderkey) from orders) * 0.9
  or o_orderkey % 20 = 0)""",
)
def _(s):
    """Orders that come back newer replace theirs, older repeats do not, unknown ones are added."""
    orders, folder = s["orders"], scratch_dir(s.spark, "merge")
    top = F.lit(orders.agg(F.max("o_orderkey")).first()[0])
    t = VersionedTable(s.spark, folder, orders.schema, ["o_orderkey"])
    t.replace(orders.where(F.col("o_orderkey") <= top * 0.9))
    back = orders.where(F.col("o_orderkey") % 20 == 0)
    newer = back.withColumn("o_orderdate", F.col("o_orderdate") + F.expr("interval 1 day")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    stale = orders.where((F.col("o_orderkey") <= top * 0.9) & (F.col("o_orderkey") % 20 == 1)).withColumn(
        "o_totalprice", F.lit(0).cast(orders.schema["o_totalprice"].dataType)
    )
    t.merge(newer.unionByName(back).unionByName(stale), "o_orderdate")
    return t.read()


@query(
    "upsert_incremental",
    """
with t as (select * from orders where o_orderdate < timestamp '1996-01-01'),
n as (select * replace (o_totalprice + 1 as o_totalprice) from orders
  where o_orderdate > (select max(o_orderdate) from t))
select * from n union all select * from t where o_orderkey not in (select o_orderkey from n)""",
)
def _(s):
    orders, folder = s["orders"], scratch_dir(s.spark, "upsert")
    old = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    orders.where(old).write.parquet(f"{folder}/v1")
    incoming = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    current = s.spark.read.parquet(f"{folder}/v1")
    merged = tables.upsert_incremental(current, incoming, "o_orderkey", "o_orderdate")
    merged.write.parquet(f"{folder}/v2")
    return s.spark.read.parquet(f"{folder}/v2")


@query(
    "tagged_append",
    """
select s_suppkey, s_name, 'first' as src from supplier
union all select s_suppkey, s_name, 'second' from supplier""",
)
def _(s):
    path = scratch_dir(s.spark, "tagged")
    rows = s["supplier"].select("s_suppkey", "s_name")
    tables.append_tagged(rows, path, "first")
    tables.append_tagged(rows, path, "second")
    return s.spark.read.parquet(path)


@query("preview_rows", "select count(*) as n from (select * from lineitem limit 100)")
def _(s):
    """Which rows a preview shows is open; how many is not."""
    return limit(tables.preview(s["lineitem"], 100), 1000).agg(F.count(F.lit(1)).alias("n"))


@query("commented_columns", "select r_regionkey, r_name from region")
def _(s):
    path = scratch_dir(s.spark, "comments")
    note = {"r_name": "name of the region"}
    tables.with_comments(s["region"], note).write.parquet(path)
    back = s.spark.read.parquet(path)
    if back.schema["r_name"].metadata.get("comment") != note["r_name"]:
        raise RuntimeError("column comment was lost")
    return back
