"""Early warning on a stream: one alert per key when a 24-hour organ score reaches a limit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalgrid.streaming.windows import windowed

HOUR_MS = 3_600_000

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB state store; the session's owner chooses it."""
    if spark.conf.get(STATE_STORE, "") != ROCKSDB:
        raise ValueError(f"set {STATE_STORE} to {ROCKSDB}")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(STATE_STORE, ROCKSDB)


def hourly_points(
    stream: DataFrame, key: str, t: str, organs: Sequence[str], lateness: str
) -> DataFrame:
    """Highest points per key, hour and organ, each hour emitted once when it is closed."""
    return windowed(
        stream, t, "1 hour", lateness, [key], [F.max(o).alias(o) for o in organs]
    )


class FirstAlert(StatefulProcessor):
    """Keeps the organ points of the last hours of one key, and whether it has been reported.

    The hours are dropped by a timer once nothing later can be compared with them; the flag stays,
    since a key is reported once.
    """

    def __init__(self, key: str, organs: Sequence[str], threshold: int, hours: int):
        self.key, self.organs = key, list(organs)
        self.threshold, self.span = threshold, hours * HOUR_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        columns = ", ".join(f"{o} int" for o in self.organs)
        self.handle = handle
        self.reported = handle.getValueState("reported", "score int")
        self.recent = handle.getListState("recent", f"end_ms bigint, {columns}")

    def handleInputRows(
        self, key, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        if self.reported.exists():
            return
        new = pd.concat(list(rows)).sort_values("window_end")
        ends = new["window_end"].astype("datetime64[ms]").astype("int64").tolist()
        points = new[self.organs].fillna(0).astype("int64").values.tolist()
        recent = [tuple(r) for r in self.recent.get()]
        for end, now in zip(ends, points):
            recent = [r for r in recent if r[0] > end - self.span] + [(end, *now)]
            score = sum(max(r[i + 1] for r in recent) for i in range(len(self.organs)))
            if score >= self.threshold:
                self.reported.update((score,))
                self.recent.clear()
                yield pd.DataFrame(
                    {
                        self.key: [key[0]],
                        "alert_time": [pd.Timestamp(end, unit="ms")],
                        "score": [score],
                    }
                )
                return
        self.recent.put(recent)
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(recent[-1][0] + self.span)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        yield from ()

    def close(self) -> None:
        pass


def early_alert(
    hourly: DataFrame, key: str, organs: Sequence[str], threshold: int, hours: int = 24
) -> DataFrame:
    """First closed hour of each key at which the organ maxima of ``hours`` hours reach a total.

    ``hourly`` comes from ``hourly_points``: one small row per key and hour, reduced on the JVM
    side, so a key's share of the raw stream does not matter here. The session must use the RocksDB
    state store (``use_rocksdb``).
    """
    require_rocksdb(hourly.sparkSession)
    return hourly.groupBy(key).transformWithStateInPandas(
        statefulProcessor=FirstAlert(key, organs, threshold, hours),
        outputStructType=f"{key} {dict(hourly.dtypes)[key]}, alert_time timestamp, score int",
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="alert_time",
    )
