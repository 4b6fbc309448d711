from tidemark.operators.daily import changed_days, daily_metrics, nearest_days, with_change
from tidemark.operators.merge import matched_versions, merge_rows, repeated_keys, require_unique
from tidemark.operators.search import keyword_scan
from tidemark.operators.series import complete_days, flatten_series, latest_per_key, recent
from tidemark.operators.state import advance_to, last_processed, latest_state, run_window, state_row
from tidemark.operators.status import failed_dates, failed_items, resume_point, run_status, run_summary
from tidemark.operators.validate import point_counts, validate, with_missing
from tidemark.operators.work import landed_exists, loaded_counts, loaded_on, pending, work_items

__all__ = [
    "advance_to",
    "changed_days",
    "complete_days",
    "daily_metrics",
    "failed_dates",
    "failed_items",
    "flatten_series",
    "keyword_scan",
    "landed_exists",
    "last_processed",
    "latest_per_key",
    "latest_state",
    "loaded_counts",
    "loaded_on",
    "matched_versions",
    "merge_rows",
    "nearest_days",
    "pending",
    "point_counts",
    "recent",
    "repeated_keys",
    "require_unique",
    "resume_point",
    "run_status",
    "run_summary",
    "run_window",
    "state_row",
    "validate",
    "with_change",
    "with_missing",
    "work_items",
]
