"""Clock arithmetic on TIMESTAMP_NTZ columns. All results are columns, no data is touched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

_UNITS = {"minute": MINUTE, "hour": HOUR, "day": DAY}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(t: str | Column) -> Column:
    return col(t).cast("timestamp_ntz")


def micros(t: str | Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(col(t).cast("timestamp"))


def block(position: Column, width: int) -> Column:
    """Index of the fixed-width block a position falls in, exact for negative positions too."""
    return ((position - F.pmod(position, F.lit(width))) / F.lit(width)).cast("long")


def index(t: str | Column, unit: str) -> Column:
    """Number of whole clock units since the epoch."""
    return block(micros(t), _UNITS[unit])


def elapsed(unit: str, start: str | Column, end: str | Column) -> Column:
    """Clock boundaries crossed between two times: 11:59 to 12:01 is one hour."""
    return index(end, unit) - index(start, unit)


def shift(t: str | Column, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    return col(t) + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(0))


def shift_months(t: str | Column, months: int) -> Column:
    return col(t) + F.make_ym_interval(F.lit(0), F.lit(months))


def trunc(unit: str, t: str | Column) -> Column:
    return ntz(F.date_trunc(unit, col(t)))


def ceil_hour(t: str | Column) -> Column:
    """The first whole hour at or after a time."""
    floor = trunc("hour", t)
    return F.when(floor == col(t), floor).otherwise(shift(floor, hours=1))
