"""Incremental: load the days since the last run and move the resume pointer."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame

from tidemark.operators.status import resume_point
from tidemark.operators.work import work_items
from tidemark.plans.results import (
    RunResult,
    load_entities,
    new_run_id,
    record_status,
    totals,
    transform,
)
from tidemark.schemas import INCREMENTAL_DAYS
from tidemark.sources.landing import landed_between
from tidemark.sources.tables import Tables

PIPELINE_NAME = "incremental"


def incremental(
    landed: DataFrame,
    tables: Tables,
    entities: DataFrame,
    as_of: date,
    first_run_days: int = INCREMENTAL_DAYS,
    lookback_days: int | None = 1,
    policy: str = "contiguous",
    now: datetime | None = None,
    pipeline_name: str = PIPELINE_NAME,
    bad_points: str = "raise",
) -> RunResult:
    """Process every (entity, day) between the resume pointer and the day before ``as_of``.

    An empty window is a success and touches nothing. Otherwise the layer builds run whatever the
    load brought; the pointer moves last, by ``policy`` (see ``resume_point``), and not at all when
    every date failed.
    """
    tables.create()
    pointer = tables.pointer(pipeline_name)
    last = pointer.processed
    start = last + timedelta(days=1) if last else as_of - timedelta(days=first_run_days)
    end = as_of - timedelta(days=1)
    if start > end:
        return RunResult(pipeline_name, None, start, end)

    run_id = new_run_id()
    items = work_items(entities.select("entity").distinct(), start, end)
    load = load_entities(tables, landed_between(landed, start, end), entities, run_id)
    status = record_status(tables, items, pipeline_name, run_id)
    bad = transform(tables, as_of, lookback_days, bad_points)

    resume = resume_point(status, policy).first()
    count, failures, ok = totals(status)
    resume_date = resume.resume_date if resume else None
    if resume_date:
        # A run beside this one may have moved the pointer further; it never goes back.
        moved = tables.move_pointer(pipeline_name, pointer, resume_date, now or datetime.now(timezone.utc))
        resume_date = moved.processed
    return RunResult(pipeline_name, run_id, start, end, ok, count, failures, load, resume_date, bad)
