"""Rolling maxima over dense grids and trailing sums over irregular times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY, HOUR, block, micros
from vitalgrid.operators.chunks import with_halo

TASK_ROWS = 250_000  # rows of a table whose trailing sums one task should take


def rolling_max_rows(
    df: DataFrame,
    key: str,
    order: str,
    n: int,
    columns: Sequence[str],
    suffix: str,
    total: str | None = None,
    width: int = 240,
    placed: bool = False,
) -> DataFrame:
    """Maximum of each column over the last ``n`` rows, missing taken as 0, and their sum.

    ``order`` must be a dense integer (one row per value, as a grid has), so n rows are n values.
    Rows that are ``placed`` lie in blocks already, with the ``n - 1`` rows before each (``_block`` and
    ``_own``, as ``with_halo`` makes them), and keep their ``_block``.
    """
    rows = df if placed else with_halo(df, F.col(order).cast("long"), width, n - 1)
    frame = (
        Window.partitionBy(key, "_block")
        .orderBy(order)
        .rowsBetween(-(n - 1), Window.currentRow)
    )
    rolled = rows.select(
        "*",
        *[F.coalesce(F.max(c).over(frame), F.lit(0)).alias(c + suffix) for c in columns],
    ).where("_own")
    rolled = rolled.drop("_own") if placed else rolled.drop("_block", "_own")
    if total:
        parts = [F.col(c + suffix) for c in columns]
        out = parts[0]
        for part in parts[1:]:
            out = out + part
        rolled = rolled.withColumn(total, out)
    return rolled


def trailing_sums(
    df: DataFrame,
    key: str,
    t: str,
    values: dict[str, str],
    clock_hours: dict[str, int],
    full_name: str,
    full_hours: int = 23,
    width: int = DAY,
    rows: int | None = None,
) -> DataFrame:
    """Sums over the key's past, one row per input row.

    ``{value}{full_name}`` covers [t - full_hours, t] by elapsed time; ``{value}{suffix}`` covers
    rows at most ``clock_hours[suffix]`` clock hours back, which is whole earlier hours plus the
    current hour up to t. ``df`` must be unique on (key, t); rows without a time get NULL.
    ``values`` maps an output stem to an input column.

    No frame slides over rows. The sum over [t - n h, t] is the current hour up to t, the whole
    hours between, and the end of the hour n hours ago. For the last part each row is also placed
    n hours later, where the rows from t onward in its hour are those that are wanted. Frames that
    grow within an hour, and frames of whole hours, cost time in proportion to the rows.

    One sort serves the first two parts, a second the third. A task holds both in memory, so with
    ``rows``, at least the number of rows of ``df``, tasks are as many as TASK_ROWS asks for; without
    it Spark merges partitions by their compressed size.
    """
    if width % HOUR or full_hours < 1:
        raise ValueError("blocks are whole hours, and the full range is one hour at least")
    full = full_hours * HOUR
    reach = max([full, *[(h + 1) * HOUR for h in clock_hours.values()]])
    home = block(F.col("_at"), width)
    copies = F.transform(
        F.sequence(home, block(F.col("_at") + reach, width)),
        lambda b: F.struct(b.alias("block"), F.lit(0).cast("long").alias("shift")),
    )
    later = F.struct(block(F.col("_at") + full, width).alias("block"), F.lit(full).cast("long").alias("shift"))
    placed = (
        df.withColumn("_at", micros(t))
        .withColumn("_place", F.explode_outer(F.concat(copies, F.array(later))))
        .withColumn("_block", F.col("_place.block"))
        .withColumn("_shift", F.coalesce("_place.shift", F.lit(0)))
        .withColumn("_own", (F.col("_shift") == 0) & F.col("_block").eqNullSafe(home))
        .withColumn("_us", F.col("_at") + F.col("_shift"))
        .withColumn("_hour", block(F.col("_us"), HOUR))
    )
    parts = [] if rows is None else [max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))]
    placed = placed.repartition(*parts, key, "_block").sortWithinPartitions(key, "_block", "_hour", "_us")
    part = Window.partitionBy(key, "_block")
    this_hour = Window.partitionBy(key, "_block", "_hour")
    upto = this_hour.orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = this_hour.orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    timed = F.col("_us").isNotNull() & F.col(key).isNotNull()

    def hours_back(value: Column, hours: int) -> Column:
        return F.sum(value).over(part.orderBy("_hour").rangeBetween(-hours, -1))

    def plus(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    outputs = []
    for stem, source in values.items():
        value = F.when(F.col("_shift") == 0, F.col(source))
        now = F.sum(value).over(upto)
        ended = F.sum(F.when(F.col("_shift") > 0, F.col(source))).over(onward)
        whole = plus(now, ended)
        if full_hours > 1:
            whole = plus(whole, hours_back(value, full_hours - 1))
        kind = df.select(F.sum(source).alias("s")).schema["s"].dataType
        outputs.append(F.when(timed, whole).cast(kind).alias(stem + full_name))
        for suffix, hours in clock_hours.items():
            outputs.append(F.when(timed, plus(now, hours_back(value, hours))).alias(stem + suffix))
    helpers = ("_at", "_place", "_block", "_shift", "_own", "_us", "_hour")
    return placed.select("*", *outputs).where("_own").drop(*helpers)


def trailing_sums_self_join(
    df: DataFrame,
    key: str,
    t: str,
    values: dict[str, str],
    clock_hours: dict[str, int],
    full_name: str,
    full_hours: int = 23,
) -> DataFrame:
    """``trailing_sums`` as the self range join it replaces: the form tests and bench compare with."""
    past = df.select(
        F.col(key).alias("_key"),
        F.col(t).alias("_then"),
        *[F.col(source).alias(f"_{stem}") for stem, source in values.items()],
    )
    age = block(micros(t), HOUR) - block(micros("_then"), HOUR)
    near = (
        (F.col(key) == F.col("_key"))
        & (micros(t) >= micros("_then"))
        & (micros(t) <= micros("_then") + full_hours * HOUR)
    )
    sums = []
    for stem in values:
        sums.append(F.sum(f"_{stem}").alias(stem + full_name))
        for suffix, hours in clock_hours.items():
            sums.append(F.sum(F.when(age <= hours, F.col(f"_{stem}"))).alias(stem + suffix))
    return df.join(past, near, "left").groupBy(key, t).agg(*sums)
