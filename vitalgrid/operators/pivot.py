"""Long event log to wide rows: one conditional aggregate per output column, one shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.cleaning import Bound


@dataclass(frozen=True)
class Measure:
    """One output column: which item codes feed it and which values count."""

    name: str
    codes: tuple
    bound: Bound | None = None
    source: str | None = None  # column to read when it is not the default value column
    agg: str | None = None  # aggregate when it is not the default one
    clean: Callable[[Column], Column] | None = None


_AGGREGATES = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum, "count": F.count}


def codes_of(spec: Sequence[Measure]) -> list[int]:
    return sorted({code for m in spec for code in m.codes})


def pivot_columns(spec: Sequence[Measure], agg: str, item: str, value: str) -> list[Column]:
    out = []
    for m in spec:
        raw = F.col(m.source or value)
        keep = F.col(item).isin(list(m.codes))
        if m.bound is not None:
            keep = keep & m.bound.holds(raw)
        cleaned = m.clean(raw) if m.clean else raw
        out.append(_AGGREGATES[m.agg or agg](F.when(keep, cleaned)).alias(m.name))
    return out


def pivot_items(
    df: DataFrame,
    keys: Sequence[str],
    spec: Sequence[Measure],
    agg: str = "max",
    item: str = "itemid",
    value: str = "valuenum",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Filter to the items of ``spec`` and aggregate each into its own column per ``keys``."""
    return (
        df.where(F.col(item).isin(codes_of(spec)))
        .groupBy(*keys)
        .agg(*extra, *pivot_columns(spec, agg, item, value))
    )
