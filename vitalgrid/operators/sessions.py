"""Sessions broken by a long gap or by a change of status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.time import DAY, elapsed
from vitalgrid.operators import chunks


def lag_in(
    df: DataFrame,
    keys1: Sequence[str],
    keys2: Sequence[str],
    t: str,
    ties: Sequence[str] = (),
    width: int | None = DAY,
) -> DataFrame:
    """Previous rows within a fine key (``prev_fine``) and within a coarse one (``prev_coarse``)."""
    extra = [k for k in keys1 if k not in keys2]
    fine = chunks.neighbours(df, keys1, t, [t], ties, previous="prev_fine", width=width)
    return chunks.neighbours(
        fine, keys2, t, [t, *extra], [*ties, *extra], previous="prev_coarse", width=width
    )


def session_id(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    new_flag: str,
    out: str = "session",
    width: int | None = DAY,
) -> DataFrame:
    """Number of session starts so far; rows at the same time share it."""
    return chunks.running_total(df, keys, t, new_flag, out, width)


def gap_change_sessions(
    df: DataFrame,
    key: str,
    t: str,
    status: str,
    gap_hours: int,
    out: str = "session",
    width: int | None = DAY,
) -> DataFrame:
    """Session number and following time (``next_t``) per row; columns key, t, status only.

    A row opens a session when it is the first, when the status differs from the previous row's,
    or when ``gap_hours`` clock hours or more passed since the last row of the same status. If the
    previous row has the same status it *is* that last row, and if it has another one the session
    breaks anyway, so the single previous row decides. Rows without key or time form no session.

    Rows are compared inside (key, block); each block hands its first and last row and its count
    of openings to the blocks after it. With blocks of equal depth, neighbours are found first and
    ``session_id`` counts the openings.
    """
    base = df.where(F.col(key).isNotNull() & F.col(t).isNotNull()).select(key, t, status)

    def opens(previous: str, now_t, now_status):
        return (
            (F.col(f"{previous}.{status}") != now_status)
            | (elapsed("hour", f"{previous}.{t}", now_t) >= gap_hours)
        )

    if width is None:
        near = chunks.neighbours(base, [key], t, [t, status], [status], "_prev", "_next", None)
        new = F.coalesce(opens("_prev", F.col(t), F.col(status)).cast("int"), F.lit(0))
        flagged = near.select(
            key,
            t,
            status,
            F.col(f"_next.{t}").alias("next_t"),
            F.when(F.col("_prev").isNull(), 1).otherwise(new).alias("_new"),
        )
        return session_id(flagged, [key], t, "_new", out, None).drop("_new")

    base = base.withColumn("_block", chunks.block_of(t, width))
    row = F.struct(t, status)
    inside = Window.partitionBy(key, "_block").orderBy(*chunks.order_last([t, status]))
    rows = base.withColumn("_prev", F.lag(row).over(inside)).withColumn(
        "_next", F.lead(row).over(inside)
    )
    rows = rows.withColumn(
        "_new", F.coalesce(opens("_prev", F.col(t), F.col(status)).cast("int"), F.lit(0))
    )
    # An opening is counted for all rows of its time: ties share a session.
    upto = (
        Window.partitionBy(key, "_block")
        .orderBy(t)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("_inside", F.sum("_new").over(upto))

    order = chunks.sort_key([t, status])
    blocks = rows.groupBy(key, "_block").agg(
        F.min_by(row, order).alias("_head"),
        F.max_by(row, order).alias("_tail"),
        F.sum("_new").alias("_openings"),
    )
    across = Window.partitionBy(key).orderBy("_block")
    blocks = blocks.withColumn("_before", F.lag("_tail").over(across)).withColumn(
        "_after", F.lead("_head").over(across)
    )
    first_opens = F.coalesce(
        opens("_before", F.col(f"_head.{t}"), F.col(f"_head.{status}")).cast("int"), F.lit(1)
    )
    blocks = blocks.withColumn("_first", first_opens)
    upto_block = across.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("_openings") + F.col("_first")).over(upto_block), F.lit(0))
    blocks = blocks.select(key, "_block", "_after", (earlier + F.col("_first")).alias("_offset"))
    return rows.join(blocks, [key, "_block"]).select(
        key,
        t,
        status,
        F.coalesce(F.col(f"_next.{t}"), F.col(f"_after.{t}")).alias("next_t"),
        (F.col("_offset") + F.col("_inside")).alias(out),
    )


def collapse_sessions(
    df: DataFrame,
    key: str,
    seq: str,
    t: str,
    next_t: str,
    gap_hours: int,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One interval per session: from its first row to the row after its last, unless that row is
    ``gap_hours`` away. Sessions of a single time are dropped."""
    ends = F.when(
        F.col(next_t).isNull() | (elapsed("hour", t, next_t) >= gap_hours), F.col(t)
    ).otherwise(F.col(next_t))
    return (
        df.groupBy(key, seq)
        .agg(
            F.min(t).alias("starttime"),
            F.max(ends).alias("endtime"),
            F.max(t).alias("_last"),
            *extra,
        )
        .where(F.col("starttime") != F.col("_last"))
        .drop("_last")
    )
