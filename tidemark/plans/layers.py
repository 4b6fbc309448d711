"""The two layer builds: raw -> staging and staging -> curated."""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.daily import CHANGE, changed_days, daily_metrics, nearest_days, with_change
from tidemark.operators.series import complete_days, flatten_series, latest_per_key, recent
from tidemark.schemas import BAD_POINTS_TABLE, CURATED, STAGING, STAGING_TABLE
from tidemark.session import materialized
from tidemark.sources.tables import Tables, in_partitions

# Which row wins when one key was ingested twice at the same time: the later array position, then
# the larger values, so that a rerun picks the same row.
TIEBREAK = ("position", "price", "market_cap", "total_volume")


@dataclass(frozen=True)
class StagingBuild:
    """The event dates that a staging build changed, and how many bad points it met."""

    touched: list[date | None]
    bad_points: int = 0


def staging_rows(
    raw: DataFrame,
    as_of: date | None,
    lookback_days: int | None = 1,
    complete_days_only: bool = False,
) -> DataFrame:
    """Points of the recently ingested envelopes, the latest ingestion per (entity, event time)."""
    points = flatten_series(recent(raw, as_of, lookback_days))
    return latest_points(points, as_of if complete_days_only else None)


def latest_points(points: DataFrame, complete_before: date | None = None) -> DataFrame:
    if complete_before is not None:
        points = complete_days(points, complete_before)
    return latest_per_key(points, STAGING_TABLE.keys, "ingestion_time", TIEBREAK).select(
        *STAGING.names
    )


def daily_rows(staging: DataFrame) -> DataFrame:
    """The whole daily table from the whole staging table."""
    return with_change(daily_metrics(staging)).select(*CURATED.names)


def neighbours(
    stack: ExitStack, curated: DataFrame, months: list[date], entities: DataFrame, bound: date, before: bool, metrics: list[str]
) -> list[DataFrame]:
    """The nearest day of each entity before (or after) ``bound``, in parts that are stored until ``stack`` ends.

    The search starts with the month of ``bound`` and the one beside it, and doubles its reach for the
    entities that have no neighbour yet. An increment whose entities were all there lately reads those
    two months, however long the history is; only for an entity that is new it goes to the end.
    """
    side = [m for m in months if (m <= bound if before else m >= bound.replace(day=1))]
    side.sort(reverse=before)
    parts, reach, left = [], 2, entities
    while side:
        chunk, side, reach = side[:reach], side[reach:], 2 * reach
        near = nearest_days(curated.filter(F.col("month").isin(chunk)), left, bound, before, metrics)
        parts.append(stack.enter_context(materialized(near, "neighbours")))
        if side:
            without = left.join(parts[-1], "entity", "left_anti")
            left = stack.enter_context(materialized(without, "without-neighbour"))
            if left.isEmpty():
                break
    return parts


def changed_rows(
    staging: DataFrame, curated: DataFrame, touched: list[date], before: DataFrame, after: DataFrame, fresh: DataFrame
) -> DataFrame:
    """Daily rows that differ once the staging rows of the ``touched`` dates have changed."""
    changed = changed_days(
        fresh=fresh,
        known=curated.filter(~F.col("date").isin(touched)),
        undated=daily_metrics(staging.filter(F.col("event_date").isNull())),
        first=min(touched),
        last=max(touched),
        before=before,
        after=after,
    )
    return changed.select(*CURATED.names)


def build_staging(
    tables: Tables,
    raw: DataFrame,
    as_of: date | None,
    lookback_days: int | None = 1,
    only_if_newer: bool = False,
    complete_days_only: bool = False,
    bad_points: str = "raise",
) -> StagingBuild:
    """Upsert recent raw points into staging.

    ``bad_points="raise"`` fails on text that is no number. ``"quarantine"`` keeps such points in the
    table ``bad_points``, with the text of their envelope's arrays at that position, and goes on with
    all others: the points are written once, apart by whether they are bad, and counted by that write.
    """
    version = "ingestion_time" if only_if_newer else None
    if bad_points == "raise":
        rows = staging_rows(raw, as_of, lookback_days, complete_days_only)
        return StagingBuild(tables.upsert("staging", rows, only_if_newer=version, unique_source=True))
    if bad_points != "quarantine":
        raise ValueError("bad_points must be raise or quarantine")
    keyed = recent(raw, as_of, lookback_days).withColumn("payload_key", F.xxhash64("payload"))
    points = flatten_series(keyed, keep=("entity", "ingestion_time", "payload_key"), bad="flag")
    counts = Observation()
    observed = points.observe(counts, F.count_if("is_bad").alias("bad"))
    with materialized(observed, "points", partition_by=["is_bad"]) as stored:
        bad = counts.get["bad"]
        if bad:
            # A payload that was delivered twice at one time is one envelope.
            apart = stored.filter("is_bad").withColumnRenamed("bad_text", "point")
            tables.upsert("bad_points", latest_per_key(apart, BAD_POINTS_TABLE.keys, "point"), unique_source=True)
        rows = latest_points(stored.filter("NOT is_bad"), as_of if complete_days_only else None)
        touched = tables.upsert("staging", rows, only_if_newer=version, unique_source=True)
    return StagingBuild(touched, bad)


def build_curated(tables: Tables, touched: list[date | None] | None = None) -> None:
    """Upsert the daily table.

    ``touched=None`` recomputes it from all of staging. With the event dates that changed, only
    those staging partitions are read and the result is the same. Rows without an event time have
    no partition date to start from, so touching them recomputes everything.
    """
    if touched is not None and not touched:
        return
    staging = tables.read("staging")
    if touched is None or None in touched:
        tables.upsert("curated", daily_rows(staging), unique_source=True)
        return
    curated, months = tables.read("curated"), tables.months()
    metrics = [c for c in CURATED.names if c not in ("entity", "date", CHANGE)]
    first, last = min(touched), max(touched)
    with ExitStack() as stack:
        days = daily_metrics(staging.filter(in_partitions("event_date", touched)))
        fresh = stack.enter_context(materialized(days, "fresh-days"))
        entities, none = fresh.select("entity").distinct(), fresh.limit(0)
        before = neighbours(stack, curated, months, entities, first, True, ["avg_price"])
        after = neighbours(stack, curated, months, entities, last, False, metrics)
        before = reduce(DataFrame.unionByName, before, none.select("entity", "date", "avg_price"))
        after = reduce(DataFrame.unionByName, after, none)
        rows = changed_rows(staging, curated, touched, before, after, fresh)
        tables.upsert("curated", rows, unique_source=True)
