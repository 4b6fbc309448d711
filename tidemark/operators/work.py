"""Work items (entity x day) and which of them are already there."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import date_range, utc_day
from tidemark.functions.dates import as_column


def work_items(
    entities: DataFrame, start: date | Column, end: date | Column, entity: str = "entity"
) -> DataFrame:
    """One row per entity and date from start to end; none when start is after end.

    The dates are generated inside each entity row, so no join is involved.
    """
    days = F.explode(date_range(start, end)).alias("run_date")
    return entities.select(F.col(entity).alias("entity"), days)


def _loads(raw: DataFrame, entity: str, ingestion_time: str) -> DataFrame:
    return raw.select(F.col(entity).alias("entity"), utc_day(ingestion_time).alias("run_date"))


def loaded_on(
    raw: DataFrame, day: date | Column, entity: str = "entity", ingestion_time: str = "ingestion_time"
) -> DataFrame:
    """Entities with a load on one UTC day."""
    if "ingestion_date" in raw.columns:
        raw = raw.filter(F.col("ingestion_date") == as_column(day))
    loads = _loads(raw, entity, ingestion_time).filter(F.col("run_date") == as_column(day))
    return loads.distinct()


def loaded_counts(
    raw: DataFrame, entity: str = "entity", ingestion_time: str = "ingestion_time"
) -> DataFrame:
    """Loads per entity and UTC ingestion day."""
    loads = _loads(raw, entity, ingestion_time)
    return loads.groupBy("entity", "run_date").agg(F.count(F.lit(1)).alias("row_count"))


def pending(
    items: DataFrame,
    raw: DataFrame,
    entity: str = "entity",
    ingestion_time: str = "ingestion_time",
    between: tuple[date, date] | None = None,
) -> DataFrame:
    """Work items without a load of that entity on that UTC day.

    Only loads of the items' dates are read. The caller names these by ``between``; else the smallest
    and the largest one are looked up first. The bounds prune ``ingestion_date`` partitions where the
    table has them, and reach the scan as a filter on the time in any case.
    """
    first, last = between or items.agg(F.min("run_date"), F.max("run_date")).first()
    if first is None:
        return items
    if "ingestion_date" in raw.columns:
        raw = raw.filter(F.col("ingestion_date").between(first, last))
    # Bounds on the time itself, as scans push those down.
    time = F.col(ingestion_time)
    raw = raw.filter((time >= F.lit(first)) & (time < F.lit(last + timedelta(days=1))))
    loads = _loads(raw, entity, ingestion_time).distinct()
    return items.join(loads, ["entity", "run_date"], "left_anti")


def landed_exists(
    keys: DataFrame, landed: DataFrame, on: Sequence[str] = ("entity", "run_date")
) -> DataFrame:
    """The keys that have at least one landed row."""
    return keys.join(landed.select(*on).distinct(), list(on), "left_semi")
