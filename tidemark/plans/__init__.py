from tidemark.plans.backfill import backfill
from tidemark.plans.incremental import incremental
from tidemark.plans.layers import build_curated, build_staging, daily_rows, staging_rows
from tidemark.plans.results import RunResult

__all__ = [
    "RunResult",
    "backfill",
    "build_curated",
    "build_staging",
    "daily_rows",
    "incremental",
    "staging_rows",
]
