"""Shared by the operators: reading tables, stored stage results, Arrow slices, components."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.session import scratch_dir

SLICE_BYTES = 2 << 20
BATCH_ROWS = 1000
FILTER_BITS = 16
PAGE_BITS = 1 << 18
MOST_BITS = 1 << 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Hand at most BATCH_ROWS rows at a time to Python: texts are long, and whole batches are held
    on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def saved(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a result to the cluster's shared folder and read it back: lost executors recompute
    nothing before this point, and later uses do not repeat the work."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now: it does so once the driver has
    collected what refers to them, which a driver with free memory puts off for half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Row ranges of each batch with about ``limit`` bytes of text; one longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = batch.column(at).cast(pa.large_binary()).fill_null(b"")
        lengths = pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()  # workers live on for other stages


def bit_filter(values: DataFrame) -> Broadcast[np.ndarray]:
    """A bit for each value of the one column of ``values`` (long), broadcast to the tasks: rows whose
    value has none need not be shuffled to meet it.

    There are FILTER_BITS for each value and at most MOST_BITS (32 MB) in all; beyond that more rows
    pass that nothing wants, which the join behind the filter drops.
    """
    wanted = FILTER_BITS * max(values.count(), 1)
    bits = min(MOST_BITS, max(PAGE_BITS, 1 << (wanted - 1).bit_length()))
    slot = F.pmod(F.col(values.columns[0]), F.lit(bits))

    def page(table: pa.Table) -> pa.Table:
        own = np.zeros(PAGE_BITS, bool)
        own[table.column("bit").to_numpy()] = True
        return pa.table({"page": table.column("page")[:1], "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    slots = values.select(
        F.floor(slot / PAGE_BITS).cast("int").alias("page"), F.pmod(slot, F.lit(PAGE_BITS)).cast("int").alias("bit")
    )
    pages = slots.distinct().groupBy("page").applyInArrow(page, "page int, bits binary").collect()
    every = np.zeros((bits // PAGE_BITS, PAGE_BITS // 8), np.uint8)
    for row in pages:  # at most MOST_BITS / 8 bytes
        every[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return values.sparkSession.sparkContext.broadcast(every.reshape(-1))


def has_bit(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values (signed 64-bit) have their bit set."""
    slot = np.mod(values, np.int64(len(bits) * 8))
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id each id reaches over ``edges`` (a, b); ids without an edge
    are absent.

    Rounds of minimum label over neighbours followed by pointer jumping, each stored; both are
    pre-aggregated joins, so a hub costs no more than its edges, and chains halve each round.
    """
    both = edges.where("a <> b").select("a", "b")
    both = saved(both.unionByName(both.selectExpr("b AS a", "a AS b")).distinct(), "edges")
    labels = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    for _ in range(max_rounds):
        old = labels.withColumnRenamed("label", "old")
        heard = (
            both.join(labels.selectExpr("a AS b", "label"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        # The label of my label is reachable too: chains of labels shorten by half.
        near = heard.join(old, "a").select("a", "old", F.least("old", "near").alias("near"))
        jumped = labels.selectExpr("a AS near", "label AS far")
        new = saved(
            near.join(jumped, "near", "left").select(
                "a", "old", F.least("near", F.coalesce("far", "near")).alias("label")
            ),
            "labels",
        )
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("a", "label")
        if not changed:
            return labels.selectExpr("a AS id", "label AS component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def union_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` indices over the links a-b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
