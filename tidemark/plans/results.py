"""What a pipeline run reports, and the steps both pipelines share."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.status import run_status, run_summary
from tidemark.plans.layers import build_curated, build_staging
from tidemark.session import materialized
from tidemark.sources.tables import LoadReport, Tables

BROADCAST_ENTITIES = 500_000


@dataclass(frozen=True)
class RunResult:
    """Truthy when every work item was loaded or already there."""

    pipeline_name: str
    run_id: str | None
    start: date
    end: date
    ok: bool = True
    items: int = 0
    failures: int = 0
    load: LoadReport | None = None
    resume_date: date | None = None
    bad_points: int = 0
    check_error: str | None = None

    def __bool__(self) -> bool:
        return self.ok


def new_run_id() -> str:
    return uuid.uuid4().hex


def load_entities(
    tables: Tables, landed: DataFrame, entities: DataFrame, run_id: str
) -> LoadReport:
    """Store the landed envelopes of the wanted entities.

    The caller has bounded the dates. Joining on the entity alone keeps the small side one row per
    entity instead of one per entity and day. The entities are written once and counted, so that they
    are broadcast by their true number and payloads stay where they are; only more than
    ``BROADCAST_ENTITIES`` of them are joined by a shuffle. A broken line names no entity and comes along.
    """
    with materialized(entities.select("entity").distinct(), "entities") as wanted:
        if wanted.count() <= BROADCAST_ENTITIES:
            wanted = F.broadcast(wanted)
        if "corrupt" in landed.columns:
            met = landed.join(wanted.withColumn("_wanted", F.lit(True)), "entity", "left")
            chosen = met.filter("_wanted OR corrupt IS NOT NULL").select(landed.columns)
        else:
            chosen = landed.join(wanted, "entity", "left_semi")
        return tables.load(chosen, run_id)


def record_status(tables: Tables, items: DataFrame, pipeline_name: str, run_id: str) -> DataFrame:
    """Write one status row per work item and return this run's rows."""
    # A line that is no envelope names no entity.
    outcomes = tables.of_load(run_id).filter("corrupt IS NULL")
    named = {"pipeline_name": pipeline_name, "run_id": run_id, "batch": run_id}
    tables.append("status", run_status(items, outcomes).withColumns({c: F.lit(v) for c, v in named.items()}))
    return tables.of_run(pipeline_name, run_id)


def totals(status: DataFrame) -> tuple[int, int, bool]:
    return tuple(run_summary(status).first())


def transform(tables: Tables, as_of: date, lookback_days: int | None, bad_points: str = "raise") -> int:
    """Both layer builds in order, and how many bad points were kept apart.

    An error in the first one keeps the second from running.
    """
    since = None if lookback_days is None else as_of - timedelta(days=lookback_days)
    build = build_staging(tables, tables.raw(since), as_of, lookback_days, bad_points=bad_points)
    build_curated(tables, build.touched)
    return build.bad_points
