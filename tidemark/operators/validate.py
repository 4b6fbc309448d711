"""Payload checks: which envelopes can be loaded, and what the others lack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_arrays
from tidemark.schemas import PAYLOAD_ARRAYS


def _sizes(df: DataFrame, names: Sequence[str], payload: str) -> tuple[DataFrame, dict[str, Column]]:
    parsed = df.withColumn("_doc", json_arrays(F.col(payload), names))
    return parsed, {n: F.coalesce(F.array_size(F.col("_doc")[n]), F.lit(0)) for n in names}


def point_counts(
    df: DataFrame, names: Sequence[str] = PAYLOAD_ARRAYS, payload: str = "payload"
) -> DataFrame:
    """Add ``n_<name>``: the number of points in each array, 0 when it is absent."""
    parsed, sizes = _sizes(df, names, payload)
    return parsed.withColumns({f"n_{n}": size for n, size in sizes.items()}).drop("_doc")


def with_missing(
    df: DataFrame, names: Sequence[str] = PAYLOAD_ARRAYS, payload: str = "payload"
) -> DataFrame:
    """Add ``missing``: the required arrays that are absent or empty. Empty list = valid."""
    parsed, sizes = _sizes(df, names, payload)
    lacking = F.array(*[F.when(size == 0, F.lit(n)) for n, size in sizes.items()])
    return parsed.withColumn("missing", F.array_compact(lacking)).drop("_doc")


def validate(
    df: DataFrame, names: Sequence[str] = PAYLOAD_ARRAYS, payload: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected); rejected rows name what is missing."""
    checked = with_missing(df, names, payload)
    is_valid = F.array_size("missing") == 0
    return checked.filter(is_valid).drop("missing"), checked.filter(~is_valid)
