"""First match inside time bands between two streams, each left row reported once.

The streaming form of ``operators.bands.first_in_band``: left rows wait in keyed state until nothing
that arrives later can lie in one of their bands, then leave with the first match of each band, or
without one. Right rows stay as long as a left row may still look back at them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalgrid.functions.time import DAY, micros
from vitalgrid.streaming.alert import require_rocksdb

NEVER = 2**62


class FirstMatch(StatefulProcessor):
    """State of one key: left rows (id, t) and right rows (id, t or none, day), times in microseconds.

    Both are lists of what lies within the bands' reach of the watermark, whatever the stream's
    length. A timer stands at the earliest close of the left rows that came together or wait on: when
    it fires, all that are closed leave at once, so timers cost a call per key and not one per row.
    """

    def __init__(
        self,
        key: str,
        bands: Mapping[str, tuple[int, int]],
        date_bands: Mapping[str, tuple[int, int]],
    ):
        self.key, self.bands, self.date_bands = key, dict(bands), dict(date_bands)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left = handle.getListState("left", "id bigint, t bigint")
        self.right = handle.getListState("right", "id bigint, t bigint, day bigint")

    def closes(self, t: int) -> int:
        """From here on, no row still to come can match a left row of time ``t``."""
        by_time = max(t + hi for _, hi in self.bands.values())
        days = [(t // DAY + last) * DAY + 1 for _, last in self.date_bands.values()]
        return max([by_time, *days])

    def timer(self, left: list) -> int:
        """The millisecond at which the first of some left rows is closed."""
        return min(-(-self.closes(t) // 1000) for _, t in left)

    def reach(self, t: int, day: int) -> int:
        """The latest left time that can match a right row."""
        if t != NEVER:
            return max(t - lo for lo, _ in self.bands.values())
        return max(((day - first + 1) * DAY for first, _ in self.date_bands.values()), default=0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        soonest = None
        for frame in rows:
            left = frame[frame["side"] == 0]
            right = frame[frame["side"] == 1]
            if len(left):
                pairs = [(int(i), int(t)) for i, t in zip(left["id"], left["t"])]
                self.left.appendList(pairs)
                first = self.timer(pairs)
                soonest = first if soonest is None else min(soonest, first)
            if len(right):
                known = right["t"].notna()
                times = right["t"].where(known, NEVER).astype("int64")
                self.right.appendList([tuple(map(int, r)) for r in zip(right["id"], times, right["day"])])
        if soonest is not None:
            self.handle.registerTimer(soonest)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        left = list(self.left.get())
        done = [r for r in left if self.closes(r[1]) <= now]
        if not done:
            return
        rights = [tuple(r) for r in self.right.get()]
        timed = sorted((t, i) for i, t, _ in rights if t != NEVER)
        dated = sorted((day, i) for i, t, day in rights if t == NEVER)
        out = {self.key: [key[0]] * len(done), "id": [r[0] for r in done]}
        for name in self.bands:
            out[name] = [self.first(name, r[1], timed, dated) for r in done]
        yield pd.DataFrame(out).astype({name: "Int64" for name in self.bands})
        waiting = [r for r in left if self.closes(r[1]) > now]
        oldest = min([now, *(r[1] for r in waiting)])
        self.left.put(waiting) if waiting else self.left.clear()
        if waiting:
            self.handle.registerTimer(self.timer(waiting))
        kept = [r for r in rights if self.reach(r[1], r[2]) >= oldest]
        self.right.put(kept) if kept else self.right.clear()

    def first(self, name: str, t: int, timed: list, dated: list) -> int | None:
        """Smallest (day, without time, time, id) of the right rows in a band."""
        lo, hi = self.bands[name]
        found = []
        at = bisect_left(timed, (t + lo,))
        if at < len(timed) and timed[at][0] < t + hi:
            found.append((timed[at][0] // DAY, 0, *timed[at]))
        if name in self.date_bands:
            first, last = self.date_bands[name]
            at = bisect_left(dated, (t // DAY + first,))
            if at < len(dated) and dated[at][0] <= t // DAY + last:
                found.append((dated[at][0], 1, 0, dated[at][1]))
        return min(found)[-1] if found else None

    def close(self) -> None:
        pass


def stream_first_match(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: str,
    left_t: str,
    right_id: str,
    right_t: str,
    bands: Mapping[str, tuple[int, int]],
    lateness: str,
    right_date: str | None = None,
    date_bands: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """(key, left_id, one right id per band): a row for each left row once its bands are closed.

    Arguments are those of ``first_in_band``; ids are long. A right row without a time matches by
    its date. It may come until the day is over, which the watermark waits for: with ``right_date``
    it stays a day further behind than ``lateness``. Rows without a key, and left rows without a
    time, take no part. The session must use the RocksDB state store.
    """
    require_rocksdb(left.sparkSession)
    kind = dict(left.dtypes)[key]
    lefts = left.where(F.col(left_t).isNotNull()).select(
        key,
        F.lit(0).alias("side"),
        F.col(left_id).cast("long").alias("id"),
        micros(left_t).alias("t"),
        F.lit(0).cast("long").alias("day"),
        F.col(left_t).cast("timestamp").alias("at"),
    )
    day = F.unix_date(F.col(right_date or right_t).cast("date")).cast("long")
    rights = right.select(
        key,
        F.lit(1).alias("side"),
        F.col(right_id).cast("long").alias("id"),
        micros(right_t).alias("t"),
        day.alias("day"),
        F.coalesce(F.col(right_t).cast("timestamp"), F.timestamp_micros(day * DAY)).alias("at"),
    )
    both = lefts.unionByName(rights).where(F.col(key).isNotNull() & F.col("at").isNotNull())
    found = (
        both.withWatermark("at", f"1 day {lateness}" if right_date else lateness)
        .groupBy(key)
        .transformWithStateInPandas(
            statefulProcessor=FirstMatch(key, bands, date_bands or {}),
            outputStructType=", ".join([f"{key} {kind}", "id bigint", *(f"{name} bigint" for name in bands)]),
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return found.withColumnRenamed("id", left_id)

