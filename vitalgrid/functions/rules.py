"""Text predicates, ordered classification, score ladders and gas formulas."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.time import col


def smallest_patterns(patterns: Iterable[str]) -> list[str]:
    """Drop patterns that contain another one: they can never decide a substring match."""
    unique = sorted(set(patterns), key=lambda p: (len(p), p))
    kept: list[str] = []
    for pattern in unique:
        if not any(k in pattern for k in kept):
            kept.append(pattern)
    return kept


def one_regex(words: Iterable[str]) -> str:
    """A regular expression for any of the words that shares common beginnings.

    Flat alternatives are all tried at every character of a text; here only words that begin
    with the character at hand are.
    """
    words = list(words)
    if "" in words:
        return ""
    arms = []
    for first in sorted({w[0] for w in words}):
        rest = [w[1:] for w in words if w[0] == first]
        head = first if first.isalnum() or first == " " else "\\" + first
        arms.append(head + one_regex(rest))
    return arms[0] if len(arms) == 1 else "(?:" + "|".join(arms) + ")"


def matches_any(text: str | Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive substring match against a list, as one compiled expression."""
    return F.lower(col(text)).rlike(one_regex(p.lower() for p in smallest_patterns(patterns)))


def exclude(
    df: DataFrame, column: str, values: Sequence[str] = (), substrings: Sequence[str] = ()
) -> DataFrame:
    """Drop listed values and rows containing a substring. A NULL is dropped, as NOT IN does."""
    text = F.lower(F.col(column))
    if values:
        df = df.where(~F.col(column).isin(list(values)))
    for part in substrings:
        df = df.where(~text.contains(part))
    return df


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first rule that holds."""
    out = None
    for condition, label in rules:
        out = F.when(condition, F.lit(label)) if out is None else out.when(condition, F.lit(label))
    return out if default is None else out.otherwise(F.lit(default))


def score_ladder(steps: Sequence[tuple[Column, int]], null_if: Column) -> Column:
    """Points of the first step that holds; NULL when nothing was measured, else 0."""
    out = None
    for condition, points in steps:
        points = F.lit(points)
        out = F.when(condition, points) if out is None else out.when(condition, points)
    return out.when(null_if, F.lit(None).cast("int")).otherwise(F.lit(0))


def positive_flag(name: str | Column, code: str | Column, negative_code: int) -> Column:
    """1 for a named finding whose code is known and is not the negative one."""
    name, code = col(name), col(code)
    return F.when((name != "") & (code != negative_code), 1).otherwise(0)


def aa_gradient(po2: Column, pco2: Column, *fio2: Column) -> Column:
    """Alveolar-arterial oxygen difference at sea level from the first known FiO2 (percent)."""
    return F.coalesce(*fio2) / 100.0 * (760 - 47) - pco2 / 0.8 - po2


def pf_ratio(po2: Column, *fio2: Column) -> Column:
    return F.try_divide(F.lit(100) * po2, F.coalesce(*fio2))
