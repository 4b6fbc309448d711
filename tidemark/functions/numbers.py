"""Arithmetic that gives null instead of an error or an infinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _infinite(x: Column) -> Column:
    return F.abs(x) == F.lit(float("inf"))


def safe_divide(x: Column, y: Column) -> Column:
    """x / y; null when y is zero or either is null, and when finite inputs overflow."""
    x, y = x.cast("double"), y.cast("double")
    ratio = F.try_divide(x, y)
    overflow = _infinite(ratio) & ~_infinite(x)
    return F.when(~overflow, ratio)


def pct_change(current: Column, previous: Column) -> Column:
    return safe_divide(current - previous, previous) * 100
