"""The organ-failure score as a running computation, fed by the streams of its inputs.

Every stay keeps the readings of hours that are still open, the infusions, ventilation episodes and
stay that have begun and not ended, and a ring of its last 24 hours' points. An hour is scored once,
when the watermark has passed its end: all that began, ended or was read up to then has come, so an
open interval covers the hour whether or not its end is known.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalgrid.functions.time import HOUR, micros
from vitalgrid.plans import items
from vitalgrid.plans.scores import ORGANS
from vitalgrid.streaming.alert import require_rocksdb

OPEN = 2**62
LEAD = 24  # hours of the grid before the first reading of a stay
RING = 24

# What an hour keeps of several readings.
LOWEST = ("meanbp_min", "gcs_min", "platelet_min")
HIGHEST = ("uo_24hr", "bilirubin_max", "creatinine_max")
RATES = ("rate_epinephrine", "rate_norepinephrine", "rate_dopamine", "rate_dobutamine")
SAMPLE, VENTILATED, STAY = "pao2fio2ratio", "ventilated", "stay"
KINDS = (*LOWEST, *HIGHEST, SAMPLE, *RATES, VENTILATED, STAY)


EVENT = np.dtype([("kind", "<i4"), ("phase", "<i4"), ("id", "<i8"), ("t", "<i8"), ("value", "<f8")])
PIECE = 20_000  # hours of one stay scored at once
BITS = 3  # of a packed row for each organ, whose points are 0 to 4


def _below(value: np.ndarray, steps) -> np.ndarray:
    return np.max([np.where(value < limit, points, 0) for limit, points in steps], axis=0)


def _from(value: np.ndarray, steps) -> np.ndarray:
    # Written so that NaN counts as the largest value, as it does in Spark.
    return np.max([np.where(~(value < limit), points, 0) for limit, points in steps], axis=0)


def _missing(name: str) -> float:
    """What an hour without a value holds: nothing is above a lowest value or below a highest one."""
    return np.inf if name in (*LOWEST, "vent", "novent") else -np.inf


def hourly_points(v: Mapping[str, np.ndarray]) -> np.ndarray:
    """Points of many hours, a row for each organ in the order of ORGANS; hours without a value of a
    kind hold ``_missing`` of it."""
    dopa, dobu, gcs, urine = v["rate_dopamine"], v["rate_dobutamine"], v["gcs_min"], v["uo_24hr"]
    pressors = [v["rate_epinephrine"], v["rate_norepinephrine"]]
    strong = ~(dopa <= 15) | ~(pressors[0] <= 0.1) | ~(pressors[1] <= 0.1)
    medium = ~(dopa <= 5) | ~np.isneginf(pressors[0]) | ~np.isneginf(pressors[1])
    weak = ~(dopa <= 0) | ~(dobu <= 0)
    heart = np.select([strong, medium, weak, v["meanbp_min"] < items.MAP_LOW], [4, 3, 2, 1], 0)
    nerves = np.max([np.where((low <= gcs) & (gcs <= high), points, 0) for low, high, points in items.CNS], axis=0)
    little = _below(np.where(np.isneginf(urine), np.inf, urine), items.URINE_24H)
    return np.stack(
        [
            np.maximum(_below(v["vent"], items.RESPIRATION_VENT), _below(v["novent"], items.RESPIRATION_NOVENT)),
            _below(v["platelet_min"], items.COAGULATION),
            _from(v["bilirubin_max"], items.LIVER),
            heart,
            np.where(gcs < items.CNS_DEEP, 4, nerves),
            np.maximum(_from(v["creatinine_max"], items.CREATININE), little),
        ]
    ).astype("int8")


VALUES = (*LOWEST, *HIGHEST, *RATES, "vent", "novent")


def organ_points(v: Mapping[str, float]) -> tuple[int, ...]:
    """Points of one hour in the order of ORGANS; a value that was not measured gives none."""
    hour = {name: np.array([v.get(name, _missing(name))], dtype="float64") for name in VALUES}
    return tuple(hourly_points(hour)[:, 0].tolist())


def _within(t: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which times lie in one of some intervals, limits included."""
    if not len(begins):
        return np.zeros(len(t), dtype=bool)
    order = np.argsort(begins)
    reach = np.maximum.accumulate(ends[order])
    at = np.searchsorted(begins[order], t, side="right") - 1
    return (at >= 0) & (reach[at] >= t)


class RunningScore(StatefulProcessor):
    """One stay. Times are microseconds; intervals are known by the id their two events share.

    State is a few packed arrays and not a row for each event: what came since the last timer is
    appended unread, and what is still open is written again when a timer fires. All hours that are
    closed then are scored together.
    """

    def __init__(self, key: str, threshold: int, alerts_only: bool = False):
        self.key, self.threshold, self.alerts_only = key, threshold, alerts_only

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrived = handle.getListState("arrived", "events binary")
        self.kept = handle.getValueState("kept", "next bigint, alerted boolean, readings binary, spans binary, ring binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = OPEN
        for frame in rows:
            events = np.empty(len(frame), EVENT)
            for name in EVENT.names:
                events[name] = frame[name].to_numpy()
            earliest = min(earliest, int(events["t"].min()))
            self.arrived.appendValue((events.tobytes(),))
        self.handle.registerTimer(self.after(earliest - earliest % HOUR + HOUR))
        yield from ()

    @staticmethod
    def after(end: int) -> int:
        return end // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        following, alerted, *packed = self.kept.get() or (OPEN, False, b"", b"", b"")
        readings, spans = (np.frombuffer(bytes(part), EVENT) for part in packed[:2])
        ring = np.frombuffer(bytes(packed[2]), "int8").reshape(len(ORGANS), -1)
        came = np.concatenate([np.frombuffer(bytes(part), EVENT) for (part,) in self.arrived.get()] or [readings[:0]])
        readings = np.concatenate([readings, came[came["phase"] == 0]])
        known = self.known(spans, came[came["phase"] != 0])
        stays = known[(known["kind"] == KINDS.index(STAY)) & (known["begin"] < OPEN)]
        # Without a stay, its grid may still begin up to a day before what comes next.
        horizon = now - (LEAD + 2) * HOUR
        if len(stays):
            first, last = int(stays["begin"].min()), int(stays["end"].max())
            origin = -(-first // HOUR) * HOUR
            following = origin - LEAD * HOUR if following == OPEN else following
            final = OPEN if last == OPEN else origin + (last // HOUR - first // HOUR) * HOUR
            upto = min(now - 1, final)
            while following <= upto:
                n = min((upto - following) // HOUR + 1, PIECE)
                points = np.concatenate([ring, hourly_points(self.worst(readings, known, following, n))], axis=1)
                ring = points[:, -(RING - 1) :]
                scored, alerted = self.rows(key[0], points, following, n, origin, alerted)
                if scored is not None:
                    yield scored
                following += n * HOUR
            if following <= final:
                horizon = following - HOUR
                self.handle.registerTimer(self.after(max(following, now)))
            else:
                horizon = OPEN  # the stay is over: nothing that comes still counts
        else:
            self.handle.registerTimer(self.after(now + HOUR))
        readings = readings[readings["t"] > horizon]
        # The stay itself is kept: later rows of it are beyond its grid, not before it.
        known = known[(known["kind"] == KINDS.index(STAY)) | (known["end"] > horizon)]
        self.arrived.clear()
        self.kept.update((following, alerted, readings.tobytes(), self.events_of(known).tobytes(), ring.tobytes()))

    @staticmethod
    def known(spans: np.ndarray, came: np.ndarray) -> np.ndarray:
        """Intervals from their events, those of before first; an end or a begin may not have come."""
        found: dict[tuple[int, int], list] = {}
        for kind, phase, ident, t, value in [*spans.tolist(), *came.tolist()]:
            span = found.setdefault((kind, ident), [OPEN, OPEN, 0.0])
            if phase == 1:
                span[0], span[2] = t, value
            else:
                span[1] = t
        fields = [("kind", "<i4"), ("id", "<i8"), ("begin", "<i8"), ("end", "<i8"), ("value", "<f8")]
        return np.array([(*ident, *span) for ident, span in found.items()], dtype=fields)

    @staticmethod
    def events_of(known: np.ndarray) -> np.ndarray:
        """The events that make up some intervals, as they are kept."""
        both = []
        for phase, side in ((1, "begin"), (2, "end")):
            some = known[known[side] < OPEN]
            events = np.empty(len(some), EVENT)
            for name, values in (("kind", some["kind"]), ("id", some["id"]), ("t", some[side]), ("value", some["value"])):
                events[name] = values
            events["phase"] = phase
            both.append(events)
        return np.concatenate(both)

    @staticmethod
    def worst(readings: np.ndarray, known: np.ndarray, following: int, n: int) -> dict[str, np.ndarray]:
        """The worst value of every kind in each of ``n`` hours, the first of which ends at ``following``."""
        values = {name: np.full(n, _missing(name)) for name in VALUES}
        # An hour holds what was read after its begin, its end included.
        slots = -(-readings["t"] // HOUR) - following // HOUR
        inside = (slots >= 0) & (slots < n)
        readings, slots = readings[inside], slots[inside]

        def keep(name: str, chosen: np.ndarray) -> None:
            better = np.fmin if name in (*LOWEST, "vent", "novent") else np.maximum
            better.at(values[name], slots[chosen], readings["value"][chosen])

        for name in (*LOWEST, *HIGHEST):
            keep(name, readings["kind"] == KINDS.index(name))
        sample = readings["kind"] == KINDS.index(SAMPLE)
        open_ = known[known["begin"] < OPEN]
        aid = open_[open_["kind"] == KINDS.index(VENTILATED)]
        aided = _within(readings["t"], aid["begin"], aid["end"])
        keep("vent", sample & aided)
        keep("novent", sample & ~aided)
        for name in RATES:
            given = open_[open_["kind"] == KINDS.index(name)]
            # Hours that end behind the begin and at or before the end.
            starts = np.clip(given["begin"] // HOUR + 1 - following // HOUR, 0, n)
            stops = np.clip(given["end"] // HOUR + 1 - following // HOUR, 0, n)
            for a, b, rate in zip(starts.tolist(), stops.tolist(), given["value"].tolist()):
                np.maximum(values[name][a:b], rate, out=values[name][a:b])
        return values

    def rows(self, key, points: np.ndarray, following: int, n: int, origin: int, alerted: bool):
        """Rows of ``n`` hours from their points and up to a day of points before them, and whether one
        of them was an alert. The maxima of a row are packed into one number: ``unpacked`` reads it."""
        before = RING - 1
        padded = np.concatenate([np.zeros((len(ORGANS), max(0, before + n - points.shape[1])), "int8"), points], axis=1)
        worst = np.lib.stride_tricks.sliding_window_view(padded, RING, axis=1).max(axis=2)
        skipped = min(max(0, (origin - following) // HOUR), n)
        if skipped == n:
            return None, alerted
        worst = worst[:, skipped:].astype("int32")
        packed = (worst << BITS * np.arange(len(ORGANS), dtype="int32")[:, None]).sum(axis=0, dtype="int32")
        ends = following + np.arange(skipped, n, dtype="int64") * HOUR
        reached = np.flatnonzero(worst.sum(axis=0) >= self.threshold)[: not alerted]
        packed[reached] |= 1 << BITS * len(ORGANS)
        alerted = alerted or len(reached) > 0
        if self.alerts_only:
            packed, ends = packed[reached], ends[reached]
        if not len(ends):
            return None, alerted
        return pd.DataFrame({self.key: key, "hr": (ends - origin) // HOUR, "end": ends, "packed": packed}), alerted

    def close(self) -> None:
        pass


def readings(stream: DataFrame, key: str, t: str, kind: str, value: str | Column) -> DataFrame:
    """A stream of measurements as events; missing values are no events."""
    v = F.col(value) if isinstance(value, str) else value
    known = stream.where(v.isNotNull() & F.col(t).isNotNull() & F.col(key).isNotNull())
    return known.select(
        key, F.lit(KINDS.index(kind)).alias("kind"), F.lit(0).alias("phase"), F.lit(0).cast("long").alias("id"),
        micros(t).alias("t"), v.cast("double").alias("value"), F.col(t).cast("timestamp").alias("at"),
    )


def intervals(stream: DataFrame, key: str, start: str, end: str, kind: str, value: str | None = None) -> DataFrame:
    """A stream of intervals as two events each, the second when the interval ends; without an end
    it stays open."""
    v = F.col(value).cast("double") if value else F.lit(0.0)
    known = stream.where(F.col(start).isNotNull() & F.col(key).isNotNull() & v.isNotNull())
    ends = F.array(
        F.struct(F.lit(1).alias("phase"), F.col(start).alias("time")), F.struct(F.lit(2).alias("phase"), F.col(end).alias("time"))
    )
    events = known.select(
        key, F.xxhash64(F.lit(kind), start, end, v).alias("id"), v.alias("value"), F.explode(ends).alias("e")
    ).where("e.time IS NOT NULL")
    return events.select(
        key, F.lit(KINDS.index(kind)).alias("kind"), F.col("e.phase").alias("phase"), "id",
        micros(F.col("e.time")).alias("t"), "value", F.col("e.time").cast("timestamp").alias("at"),
    )


def running_score(
    events: Iterable[DataFrame], key: str, lateness: str, threshold: int = 2, alerts_only: bool = False
) -> DataFrame:
    """(key, hr, endtime, organ maxima of 24 hours, sofa_24hours, alert) for every closed hour.

    ``events`` are streams made by ``readings`` and ``intervals``, one of them of kind STAY. ``alert``
    marks the first hour of a stay that reaches ``threshold``; with ``alerts_only`` every hour is scored
    and only those marked leave. The session must use RocksDB state.
    """
    streams = list(events)
    both = streams[0]
    for other in streams[1:]:
        both = both.unionByName(other)
    require_rocksdb(both.sparkSession)
    kind = dict(both.dtypes)[key]
    packed = (
        both.withWatermark("at", lateness)
        .groupBy(key)
        .transformWithStateInPandas(
            statefulProcessor=RunningScore(key, threshold, alerts_only),
            outputStructType=f"{key} {kind}, hr bigint, end bigint, packed int",
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return packed.select(
        key, F.col("hr").cast("int").alias("hr"), F.timestamp_micros("end").alias("endtime"), *unpacked(F.col("packed"))
    )


def unpacked(packed: Column) -> list[Column]:
    """Organ maxima, their sum and the alert from the number that holds them."""
    worst = [F.shiftright(packed, BITS * i).bitwiseAND((1 << BITS) - 1) for i in range(len(ORGANS))]
    alert = F.shiftright(packed, BITS * len(ORGANS)) == 1
    return [
        *[w.alias(f"{o}_24hours") for o, w in zip(ORGANS, worst, strict=True)],
        reduce(add, worst).alias("sofa_24hours"),
        alert.alias("alert"),
    ]
