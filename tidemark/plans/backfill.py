"""Backfill: load what was landed for one day, unless that entity was loaded that day already."""

from __future__ import annotations

from contextlib import ExitStack
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame

from tidemark.operators.work import loaded_on, work_items
from tidemark.plans.results import (
    RunResult,
    load_entities,
    new_run_id,
    record_status,
    totals,
    transform,
)
from tidemark.session import materialized
from tidemark.sources.landing import landed_between
from tidemark.sources.tables import Tables

PIPELINE_NAME = "backfill"


def backfill(
    landed: DataFrame,
    tables: Tables,
    entities: DataFrame,
    as_of: date,
    lookback_days: int | None = 1,
    advance_state: bool = False,
    now: datetime | None = None,
    pipeline_name: str = PIPELINE_NAME,
    bad_points: str = "raise",
    strict_check: bool = False,
) -> RunResult:
    """Run the backfill of UTC day ``as_of``.

    ``landed`` has the columns of ``schemas.LANDED``. An entity that already has raw rows ingested
    on that day is skipped and counts as a success. If that cannot be found out, every entity is
    loaded (staging keeps one row per key either way) and the result's ``check_error`` says why;
    ``strict_check`` raises instead. One bad entity never stops the others, and the layer builds run
    even when nothing was loaded.
    """
    tables.create()
    run_id, check_error = new_run_id(), None
    wanted = work_items(entities.select("entity").distinct(), as_of, as_of)
    with ExitStack() as stack:
        # The load changes what counts as done, so the list is fixed before it starts.
        try:
            done = loaded_on(tables.raw(as_of, as_of), as_of)
            items = stack.enter_context(materialized(wanted.join(done, ["entity", "run_date"], "left_anti"), "backfill-items"))
        except Exception as error:
            if strict_check:
                raise
            check_error = f"{type(error).__name__}: {error}"
            items = stack.enter_context(materialized(wanted, "backfill-items"))
        load = load_entities(tables, landed_between(landed, as_of, as_of), items, run_id)
        status = record_status(tables, items, pipeline_name, run_id)
    bad = transform(tables, as_of, lookback_days, bad_points)
    count, failures, ok = totals(status)
    resume_date = None
    if advance_state and ok:
        # A backfill sets its pointer to its day, be that earlier than the one before.
        seen = tables.pointer(pipeline_name)
        resume_date = tables.move_pointer(pipeline_name, seen, as_of, now or datetime.now(timezone.utc)).processed
    return RunResult(pipeline_name, run_id, as_of, as_of, ok, count, failures, load, resume_date, bad, check_error)
