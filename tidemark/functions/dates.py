"""Date and timestamp expressions. The session time zone is UTC (``session.configure``)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def utc_day(ts: Column | str) -> Column:
    return F.to_date(ts)


def in_utc_day_window(ts: Column | str, as_of: date | Column, lookback_days: int) -> Column:
    """True from ``lookback_days`` days before ``as_of`` on. There is no upper bound."""
    return utc_day(ts) >= F.date_sub(as_column(as_of), lookback_days)


def date_range(start: date | Column, end: date | Column) -> Column:
    """Every date from start to end, null when start is after end."""
    first, last = as_column(start), as_column(end)
    return F.when(first <= last, F.sequence(first, last))


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with microseconds and a ``+00:00`` offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
