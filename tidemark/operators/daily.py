"""Daily rollup per entity and the change against the previous present day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import pct_change, utc_day

CHANGE = "daily_price_change_pct"


def daily_metrics(
    df: DataFrame,
    entity: str = "entity",
    event_time: str = "event_time",
    price: str = "price",
    volume: str | None = "total_volume",
    market_cap: str | None = "market_cap",
) -> DataFrame:
    """Average, highest and lowest price, volume sum and average market cap per (entity, UTC day).

    Aggregates skip nulls. Map tasks pre-aggregate, so a hot entity sends one row per day and task.
    """
    measures = [
        F.avg(price).alias("avg_price"),
        F.max(price).alias("max_price"),
        F.min(price).alias("min_price"),
    ]
    if volume:
        measures.append(F.sum(volume).alias("total_volume"))
    if market_cap:
        measures.append(F.avg(market_cap).alias("avg_market_cap"))
    day = utc_day(event_time).alias("date")
    return df.groupBy(F.col(entity).alias("entity"), day).agg(*measures)


def _previous(column: str) -> Column:
    # One row per day and entity, so a window over an entity is bounded by the calendar.
    return F.lag(column).over(Window.partitionBy("entity").orderBy("date"))


def with_change(daily: DataFrame) -> DataFrame:
    """Add the change in percent against the entity's previous present date."""
    changed = daily.withColumn("_prev", _previous("avg_price"))
    return changed.withColumn(CHANGE, pct_change(F.col("avg_price"), F.col("_prev"))).drop("_prev")


def nearest_days(
    known: DataFrame, entities: DataFrame, bound: date, before: bool, metrics: list[str]
) -> DataFrame:
    """One row for each of the ``entities``: its last date before ``bound``, or its first one after it.

    Aggregated in the map tasks, so a long history sends one row per entity and task.
    """
    day, pick = F.col("date"), F.max_by if before else F.min_by
    side = known.filter(day < bound if before else day > bound).join(entities, "entity", "left_semi")
    date_of = (F.max if before else F.min)("date").alias("date")
    return side.groupBy("entity").agg(date_of, *[pick(m, "date").alias(m) for m in metrics])


def changed_days(
    fresh: DataFrame, known: DataFrame, undated: DataFrame, first: date, last: date, before: DataFrame, after: DataFrame
) -> DataFrame:
    """Rows of the daily table that differ after the days in ``fresh`` were recomputed.

    ``known``: daily rows of all other dates. ``undated``: current rollup of rows without an event
    time, which sorts before every date. ``first``/``last``: smallest and largest recomputed date.
    ``before``/``after``: the nearest day of each entity on either side, see ``nearest_days``.
    A day's change looks back one present date, so the answer is the fresh days plus the next
    present day of each entity. Outside [first, last] one neighbour per entity is enough; the
    window runs over those and the days in between, not over the whole history.
    """
    metrics = [c for c in fresh.columns if c not in ("entity", "date")]
    between = known.filter(F.col("date").between(first, last))
    if "month" in known.columns:  # prunes partitions
        between = between.filter(F.col("month").between(first.replace(day=1), last.replace(day=1)))
    # Of the day before, nothing but the average price is used.
    unused = [F.lit(None).cast(fresh.schema[m].dataType).alias(m) for m in metrics if m != "avg_price"]
    rows = fresh.withColumn("_fresh", F.lit(True))
    for context in (undated, before.select("entity", "date", "avg_price", *unused), between, after):
        part = context.select(*fresh.columns)
        rows = rows.unionByName(part.withColumn("_fresh", F.lit(False)))
    marked = rows.withColumn("_follows", F.coalesce(_previous("_fresh"), F.lit(False)))
    changed = with_change(marked)
    return changed.filter("_fresh OR _follows").drop("_fresh", "_follows")
