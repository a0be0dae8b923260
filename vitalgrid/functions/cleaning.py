"""Value cleaning: plausibility bounds, unit repair, code merging."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalgrid.functions.time import col


@dataclass(frozen=True)
class Bound:
    """A plausible range. Limits are open unless named in ``closed`` ("low", "high")."""

    low: float | None = None
    high: float | None = None
    closed: tuple[str, ...] = ()

    def holds(self, value: Column) -> Column:
        tests = []
        if self.low is not None:
            tests.append(value >= self.low if "low" in self.closed else value > self.low)
        if self.high is not None:
            tests.append(value <= self.high if "high" in self.closed else value < self.high)
        out = F.lit(True)
        for test in tests:
            out = out & test
        return out


def require(df, columns: Iterable[str]):
    """Keep rows where every named column is present."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def filter_items(df, code: str, codes: Iterable[int]):
    """Keep rows whose code is listed; reaches the file scan as an In filter."""
    return df.where(F.col(code).isin(sorted(codes)))


def bounded(value: str | Column, item: str | Column, bounds: Mapping[object, Bound]) -> Column:
    """NULL where a value lies outside its item's range; items without a range pass."""
    value, item = col(value), col(item)
    out = None
    for code, bound in bounds.items():
        kept = F.when(bound.holds(value), value)
        out = F.when(item == code, kept) if out is None else out.when(item == code, kept)
    return value if out is None else out.otherwise(value)


def positive_except(value: str | Column, item: str | Column, exempt: Iterable) -> Column:
    """True for positive values, and for any value of an exempt item."""
    return (col(value) > 0) | col(item).isin(list(exempt))


# How an inspired-oxygen reading is understood: (range read as a fraction, range read as percent).
# The three records differ at their limits and are kept apart on purpose.
FIO2_RULES = {
    "lab": (Bound(0.2, 1.0, ("high",)), Bound(20, 100, ("high",))),
    "chart": (Bound(0.2, 1, ("high",)), Bound(20, 100, ("low", "high"))),
    "ventilator": (Bound(0.2, 1, ("low", "high")), Bound(20, 100, ("low", "high"))),
}


def fio2_percent(value: str | Column, rule: str) -> Column:
    """Inspired oxygen in percent; readings in neither range become NULL."""
    value = col(value)
    fraction, percent = FIO2_RULES[rule]
    return F.when(fraction.holds(value), value * 100).when(percent.holds(value), value)


def to_celsius(value: str | Column, item: str | Column, fahrenheit: Iterable) -> Column:
    value = col(value)
    return F.when(col(item).isin(list(fahrenheit)), (value - 32) / 1.8).otherwise(value)


def dose_mcg(rate: str | Column, unit: str | Column, weight: str | Column) -> Column:
    """Rates in micrograms; a milligram rate at weight 1 was recorded in micrograms already."""
    rate = col(rate)
    milligrams = (col(unit) == "mg/kg/min") & ~F.coalesce(col(weight) == 1, F.lit(False))
    return F.when(milligrams, rate * 1000.0).otherwise(rate)


def signed_volume(value: str | Column, item: str | Column, negative: Iterable) -> Column:
    """Positive volumes of the listed items count as negative."""
    value = col(value)
    return F.when(col(item).isin(list(negative)) & (value > 0), -value).otherwise(value)


def merge_codes(item: str | Column, mapping: Mapping) -> Column:
    out = None
    item = col(item)
    for old, new in mapping.items():
        out = F.when(item == old, F.lit(new)) if out is None else out.when(item == old, F.lit(new))
    return item if out is None else out.otherwise(item)
