"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_utc


def has_keyword(text: Column | str, needle: str) -> Column:
    """Literal, case-sensitive substring test over the whole text."""
    column = F.col(text) if isinstance(text, str) else text
    return column.contains(needle)


def zero_pad(number: Column | str, width: int = 3) -> Column:
    """Left-pad with zeros; numbers wider than ``width`` stay whole."""
    return F.format_string(f"%0{width}d", number)


def landing_key(entity: Column, day: Column, ingestion_time: Column, prefix: str = "raw") -> Column:
    """Object key ``<prefix>/<entity>/<day>/<ingestion time>.json``."""
    name = F.concat(iso_utc(ingestion_time), F.lit(".json"))
    return F.concat_ws("/", F.lit(prefix), entity, day.cast("string"), name)
