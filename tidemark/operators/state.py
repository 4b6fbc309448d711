"""Per-pipeline resume state: read the pointer, derive the next window, move the pointer."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import as_column
from tidemark.schemas import STATE


def state_row(spark: SparkSession, pipeline_name: str, processed: date, now: datetime) -> DataFrame:
    return spark.createDataFrame([(pipeline_name, processed, now)], STATE)


def last_processed(state: DataFrame, pipeline_name: str) -> date | None:
    """The newest pointer of one pipeline, of equally new ones the later date; None on its first run."""
    mine = state.filter(F.col("pipeline_name") == F.lit(pipeline_name))
    order = (F.col("updated_at").desc(), F.col("last_processed_date").desc())
    newest = mine.orderBy(*order).select("last_processed_date").head(1)
    return newest[0][0] if newest else None


def latest_state(state: DataFrame) -> DataFrame:
    """The newest pointer of every pipeline, of equally new ones the later date.

    A missing ``updated_at`` counts as oldest, a missing date as earliest.
    """
    age = F.struct(F.coalesce(F.unix_micros("updated_at"), F.lit(-(2**63))), "last_processed_date")
    return state.groupBy("pipeline_name").agg(
        F.max_by("last_processed_date", age).alias("last_processed_date"),
        F.max("updated_at").alias("updated_at"),
    )


def run_window(
    state: DataFrame, pipelines: DataFrame, as_of: date | Column, first_run_days: int = 2
) -> DataFrame:
    """Missing window per pipeline: day after the pointer (or ``as_of - first_run_days``) to yesterday."""
    today = as_column(as_of)
    start = F.coalesce(
        F.date_add("last_processed_date", 1), F.date_sub(today, first_run_days)
    ).alias("start_date")
    end = F.date_sub(today, 1).alias("end_date")
    pointers = latest_state(state).drop("updated_at")
    window = pipelines.join(pointers, "pipeline_name", "left").select("pipeline_name", start, end)
    return window.withColumn("up_to_date", F.col("start_date") > F.col("end_date"))


def advance_to(resume: DataFrame, now: datetime) -> DataFrame:
    """State rows for the pipelines whose pointer moves."""
    moved = resume.filter(F.col("resume_date").isNotNull())
    return moved.select(
        "pipeline_name", F.col("resume_date").alias("last_processed_date"), F.lit(now).alias("updated_at")
    )
