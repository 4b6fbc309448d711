"""Outcome of a run per work item, and what it means for the resume point."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import METRICS

NOT_LANDED = "not landed"
POLICIES = ("contiguous", "max_success")


def run_status(items: DataFrame, outcomes: DataFrame, fields: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """``ok`` and ``reason`` for every item; no item is lost because another failed.

    ``outcomes`` has entity, run_date and ``missing`` (empty = loaded), any number of rows per
    item. An item is ok when at least one of its envelopes was loaded. It is reduced to one row
    per item before the join; of several rejected envelopes the one that lacks the earliest
    ``fields`` gives the reason.
    """
    # One bit per array: numbers are aggregated in a hash table, text would be sorted.
    bits = [F.when(F.array_contains("missing", n), 1 << k).otherwise(0) for k, n in enumerate(fields)]
    mask = reduce(Column.__add__, bits)
    per_item = outcomes.groupBy("entity", "run_date").agg(
        F.max(F.array_size("missing") == 0).alias("_loaded"),
        F.min(F.when(F.array_size("missing") > 0, mask)).alias("_mask"),
    )
    joined = items.join(per_item, ["entity", "run_date"], "left")
    ok = F.coalesce("_loaded", F.lit(False))
    named = [F.when(F.col("_mask").bitwiseAND(1 << k) > 0, n) for k, n in enumerate(fields)]
    lacking = F.concat(F.lit("missing or empty: "), F.concat_ws(", ", *named))
    reason = F.when(F.col("_mask").isNull(), NOT_LANDED).otherwise(lacking)
    return joined.select(*items.columns, ok.alias("ok"), F.when(~ok, reason).alias("reason"))


def run_summary(status: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Item and failure counts, and whether everything went well.

    The failures themselves are ``failed_items``: a list in one cell would not scale.
    """
    return status.groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(~F.col("ok")).alias("failures"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("all_ok"),
    )


def failed_items(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("ok"))


def failed_dates(status: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Dates with at least one failed item, in order."""
    return failed_items(status).select(*by, "run_date").distinct().orderBy(*by, "run_date")


def resume_point(
    status: DataFrame, policy: str = "contiguous", by: Sequence[str] = ("pipeline_name",)
) -> DataFrame:
    """The date each pipeline may move its pointer to; null = it must not move.

    ``max_success`` takes the last date on which every item was ok, even past a failed date.
    ``contiguous`` takes the last date before the first failed one, so failed dates are retried.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    dates = status.groupBy(*by, "run_date").agg(F.bool_and("ok").alias("ok"))
    if policy == "contiguous":
        so_far = Window.partitionBy(*by).orderBy("run_date")
        dates = dates.withColumn("ok", F.min("ok").over(so_far))
    return dates.groupBy(*by).agg(F.max(F.when(F.col("ok"), F.col("run_date"))).alias("resume_date"))
