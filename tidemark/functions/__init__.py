from tidemark.functions.dates import date_range, in_utc_day_window, iso_utc, utc_day
from tidemark.functions.json_points import (
    checked_double,
    checked_millis,
    json_arrays,
    nested_arrays,
    number_points,
    points_json,
    text_points,
)
from tidemark.functions.numbers import pct_change, safe_divide
from tidemark.functions.text import has_keyword, landing_key, zero_pad

__all__ = [
    "checked_double",
    "checked_millis",
    "date_range",
    "has_keyword",
    "in_utc_day_window",
    "iso_utc",
    "json_arrays",
    "landing_key",
    "nested_arrays",
    "number_points",
    "pct_change",
    "points_json",
    "safe_divide",
    "text_points",
    "utc_day",
    "zero_pad",
]
