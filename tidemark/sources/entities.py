"""The configured entities as a relation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def entities(spark: SparkSession, ids: Iterable[str]) -> DataFrame:
    """One row per distinct id. A config table with an ``entity`` column does just as well."""
    return spark.createDataFrame([(i,) for i in dict.fromkeys(ids)], "entity string")


def configured(table: DataFrame, column: str, where: Column | str | None = None) -> DataFrame:
    """The entities that a configuration table names in a column: distinct, without blanks around them or none."""
    rows = table if where is None else table.filter(where)
    return rows.select(F.trim(F.col(column).cast("string")).alias("entity")).filter("entity <> ''").distinct()
