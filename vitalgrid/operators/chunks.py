"""Ordered per-key computations that never put a whole key into one task.

A window partitioned by a key alone sends everything that key owns to one task. Here the key's
time axis is cut into fixed blocks and the window is partitioned by (key, block):

* bounded look-back: a row is copied into each later block its reach extends to (``with_halo``);
* unbounded look-back: each block is first reduced to a summary row by a partial aggregate, the
  summaries (one per block) are ordered per key, and a block receives its neighbour's summary as
  one extra row (``neighbours``, ``running_total``, ``row_number_by_key``).

A key may hold any share of the rows; a task holds one block of it. Blocks of a fixed width suit data
that is spread over time. Where one block of one key can be too much for a task, ``width=None`` asks
for blocks of equal depth instead: rows are dealt to ranges of (key, time, ties) whose limits Spark
samples from the data, so a key is cut as often as it fills ranges, inside a day, an instant, or the
rows without a time alike. ``width_for`` measures which of the two a table needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY, block, micros
from vitalgrid.session import scratch_dir

BLOCK_ROWS = 1_000_000  # rows of a block of fixed width that a task should take

_LAST = 2**62  # block of rows without a time: after every real block


def block_of(t: str, width: int) -> Column:
    return F.coalesce(block(micros(t), width), F.lit(_LAST))


def order_last(names: Sequence[str]) -> list[Column]:
    """Ascending with missing values last, the order used everywhere in this package."""
    return [F.col(n).asc_nulls_last() for n in names]


def sort_key(names: Sequence[str]) -> Column:
    """A struct that compares like ``order_last`` does."""
    parts = []
    for i, name in enumerate(names):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)


def equal_depth(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows with the number of their range of (keys, order) as ``_block``, stored.

    Numbers ascend with the order, missing values last. Rows equal in all of it are dealt at random,
    so that they too can be cut. ``parts`` is the number of ranges; by default that of shuffle
    partitions, small neighbours merged. The rows are written once, since the limits are sampled
    anew whenever they are computed.
    """
    salted = df.withColumn("_salt", F.rand(17))
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order_last(order), F.col("_salt").asc()]
    ranged = salted.repartitionByRange(parts, *by) if parts else salted.repartitionByRange(*by)
    numbered = ranged.drop("_salt").withColumn("_block", F.spark_partition_id().cast("long"))
    path = scratch_dir(df.sparkSession, "ranges")
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def placed(
    df: DataFrame, keys: Sequence[str], t: str, ties: Sequence[str], width: int | None
) -> DataFrame:
    """Rows with their block: of a fixed width, or of equal depth where ``width`` is None."""
    if width is None:
        return equal_depth(df, keys, [t, *ties])
    return df.withColumn("_block", block_of(t, width))


def width_for(
    df: DataFrame, keys: Sequence[str], t: str, width: int = DAY, rows: int = BLOCK_ROWS
) -> int | None:
    """``width``, or None where a block of that width holds more than ``rows`` rows of one key."""
    largest = df.groupBy(*keys, block_of(t, width).alias("_block")).count().agg(F.max("count")).first()[0]
    return width if largest is None or largest <= rows else None


def with_halo(df: DataFrame, position: Column, width: int, reach: int) -> DataFrame:
    """Place each row in its block and in every later block it can reach.

    Adds ``_block`` and ``_own``; a result is read from the ``_own`` copy only. Rows without a
    position keep one copy.
    """
    first = block(position, width)
    last = block(position + F.lit(reach), width)
    placed = df.withColumn("_home", first).withColumn(
        "_block", F.explode_outer(F.sequence(first, last))
    )
    return placed.withColumn("_own", F.col("_block").eqNullSafe(F.col("_home"))).drop("_home")


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    columns: Sequence[str],
    ties: Sequence[str] = (),
    previous: str | None = "_prev",
    following: str | None = None,
    width: int | None = DAY,
) -> DataFrame:
    """Previous and/or following row of the same key, at any distance.

    Each is a struct of ``columns``, NULL at the ends. Order is (t, ties), NULLs last.
    """
    keys = list(keys)
    order = [t, *ties]
    payload = F.struct(*columns)
    base = placed(df, keys, t, ties, width)
    edges = base.groupBy(*keys, "_block").agg(
        F.max_by(payload, sort_key(order)).alias("_tail"),
        F.min_by(payload, sort_key(order)).alias("_head"),
    )
    across = Window.partitionBy(*keys).orderBy("_block")
    rows = base.withColumn("_payload", payload).withColumn("_place", F.lit(1))
    parts = []
    if previous:
        parts.append(
            edges.select(
                *keys,
                F.lead("_block").over(across).alias("_block"),
                F.col("_tail").alias("_payload"),
                F.lit(0).alias("_place"),
            )
        )
    if following:
        parts.append(
            edges.select(
                *keys,
                F.lag("_block").over(across).alias("_block"),
                F.col("_head").alias("_payload"),
                F.lit(2).alias("_place"),
            )
        )
    for part in parts:
        rows = rows.unionByName(
            part.where(F.col("_block").isNotNull()), allowMissingColumns=True
        )
    inside = Window.partitionBy(*keys, "_block").orderBy("_place", *order_last(order))
    if previous:
        rows = rows.withColumn(previous, F.lag("_payload").over(inside))
    if following:
        rows = rows.withColumn(following, F.lead("_payload").over(inside))
    return rows.where(F.col("_place") == 1).drop("_place", "_payload", "_block")


def _offsets(base: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    """Sum of all earlier blocks of the key, one row per block."""
    across = Window.partitionBy(*keys).orderBy("_block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    return (
        base.groupBy(*keys, "_block")
        .agg(amount.alias("_amount"))
        .select(
            *keys,
            "_block",
            F.coalesce(F.sum("_amount").over(before), F.lit(0)).cast("long").alias("_amount"),
            F.lit(0).alias("_place"),
        )
    )


def running_total(
    df: DataFrame, keys: Sequence[str], t: str, amount: str, out: str, width: int | None = DAY
) -> DataFrame:
    """Running sum of an integer column per key in time order; rows at one time share a value."""
    keys = list(keys)
    if width is None:
        # Times are made unique first, so no time can lie on both sides of a limit.
        times = df.groupBy(*keys, t).agg(F.sum(F.col(amount).cast("long")).alias("_sum"))
        totals = running_number(times, keys, t, "_sum", "_total").select(
            *[F.col(c).alias(f"_at_{c}") for c in (*keys, t)], F.col("_total").alias(out)
        )
        same = F.lit(True)
        for c in (*keys, t):
            same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
        return df.join(totals, same, "left").drop(*[f"_at_{c}" for c in (*keys, t)])
    return _running(df.withColumn("_block", block_of(t, width)), keys, t, amount, out)


def running_number(
    times: DataFrame, keys: Sequence[str], t: str, amount: str, out: str
) -> DataFrame:
    """(keys, t, out): the running total of rows unique on (keys, t), in blocks of equal depth."""
    keys = list(keys)
    return _running(equal_depth(times, keys, [t]), keys, t, amount, out).select(*keys, t, out)


def _running(base: DataFrame, keys: Sequence[str], t: str, amount: str, out: str) -> DataFrame:
    offsets = _offsets(base, keys, F.sum(amount))
    rows = (
        base.withColumn("_amount", F.col(amount).cast("long"))
        .withColumn("_place", F.lit(1))
        .unionByName(offsets, allowMissingColumns=True)
    )
    upto = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_place", F.col(t).asc_nulls_last())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn(out, F.sum("_amount").over(upto))
        .where(F.col("_place") == 1)
        .drop("_place", "_amount", "_block")
    )


def row_number_by_key(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    out: str,
    ties: Sequence[str] = (),
    width: int | None = DAY,
) -> DataFrame:
    """Row number per key over (t, ties), NULLs last."""
    keys = list(keys)
    base = placed(df, keys, t, ties, width)
    offsets = _offsets(base, keys, F.count(F.lit(1)))
    rows = (
        base.withColumn("_amount", F.lit(None).cast("long"))
        .withColumn("_place", F.lit(1))
        .unionByName(offsets, allowMissingColumns=True)
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("_place", *order_last([t, *ties]))
    # The offset row sorts first, so the running maximum sees it everywhere in the block.
    number = F.row_number().over(inside) - 1 + F.max("_amount").over(inside)
    return (
        rows.withColumn(out, number.cast("int"))
        .where(F.col("_place") == 1)
        .drop("_place", "_amount", "_block")
    )
