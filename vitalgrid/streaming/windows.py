"""Event-time windows and time-range joins over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(stream: DataFrame, t: str, lateness: str) -> DataFrame:
    """Declare the event time and how late rows may come; the column becomes a TIMESTAMP."""
    return stream.withColumn(t, F.col(t).cast("timestamp")).withWatermark(t, lateness)


def windowed(
    stream: DataFrame,
    t: str,
    size: str,
    lateness: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
) -> DataFrame:
    """Tumbling windows per key, each emitted once when the watermark has passed it.

    Rows later than the watermark are dropped. State is one aggregate row per open window and key.
    """
    keys = list(keys)
    totals = (
        with_event_time(stream, t, lateness).groupBy(*keys, F.window(t, size)).agg(*aggregates)
    )
    values = [c for c in totals.columns if c not in (*keys, "window")]
    return totals.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *values,
    )


def stream_range_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_t: str,
    right_t: str,
    before: str,
    after: str,
) -> DataFrame:
    """Pairs with left_t in (right_t - after, right_t + before], both sides streams.

    Both sides need a watermark. The two bounds tell Spark how long a row can still find a
    partner, so it forgets rows beyond that.
    """
    lt, rt = F.col(left_t), F.col(right_t)
    near = (
        (F.col(left_key) == F.col(right_key))
        & (lt <= rt + F.expr(f"interval {before}"))
        & (lt > rt - F.expr(f"interval {after}"))
    )
    return left.join(right, near, "inner")
