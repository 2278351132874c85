"""Column-level helpers.  Everything here returns a Spark ``Column`` built from
built-in functions, so it stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col) -> Column:
    """Exact 2-decimal value.  Sums of it do not depend on summation order,
    so ties and strict comparisons are the same on every partitioning."""
    return _c(col).cast(MONEY)


def to_double(col) -> Column:
    return _c(col).cast("double")


def day_of(col) -> Column:
    """Calendar day of a timestamp (``ts::DATE``)."""
    return _c(col).cast("date")


def pg_weekday(col) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday (``EXTRACT(DOW ...)``)."""
    return F.dayofweek(_c(col)) - 1


def iso_weekday(col) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday (``EXTRACT(ISODOW ...)``)."""
    return F.weekday(_c(col)) + 1


def is_true(col) -> Column:
    """``x IS TRUE``: NULL is neither true nor false."""
    return _c(col).eqNullSafe(F.lit(True))


def is_false(col) -> Column:
    """``x IS FALSE``."""
    return _c(col).eqNullSafe(F.lit(False))


def _bound(value: dt.date, like_ts: bool) -> Column:
    # Literals typed like the column so the comparison is pushed to the
    # parquet scan as a range (``year(ts) = y`` would not be).
    # A timestamp_ntz literal parsed from text: no time zone (neither the
    # Python process's nor the session's) takes part.
    if like_ts:
        return F.lit(f"{value.isoformat()} 00:00:00").cast("timestamp_ntz")
    return F.lit(value)


def in_year(col, year: int, timestamp: bool = True) -> Column:
    """``EXTRACT(YEAR FROM col) = year`` written as a half-open range."""
    c = _c(col)
    return (c >= _bound(dt.date(year, 1, 1), timestamp)) & \
           (c < _bound(dt.date(year + 1, 1, 1), timestamp))


def before_year(col, year: int, timestamp: bool = True) -> Column:
    """``EXTRACT(YEAR FROM col) < year`` as a range."""
    return _c(col) < _bound(dt.date(year, 1, 1), timestamp)


def in_month(col, year: int, month: int, timestamp: bool = True) -> Column:
    """Year and month equal, as a half-open range."""
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    c = _c(col)
    return (c >= _bound(start, timestamp)) & (c < _bound(end, timestamp))


def on_days(col, days, timestamp: bool = True) -> Column:
    """``col::DATE IN (days)`` as an OR of one-day ranges (pushed to the scan)."""
    c = _c(col)
    cond = None
    for d in days:
        one = (c >= _bound(d, timestamp)) & (c < _bound(d + dt.timedelta(days=1), timestamp))
        cond = one if cond is None else (cond | one)
    return cond
