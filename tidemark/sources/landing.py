"""The landing area: newline-JSON envelopes under ``by_date=.../by_entity=...`` folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tidemark.functions import iso_utc
from tidemark.schemas import LANDED, ORIGIN
from tidemark.session import listed

# The date first: the folders of one date are listed without those of the others.
LAYOUT = ("by_date", "by_entity")
BAD_LINES = ("raise", "keep")


def landed_schema(bad: str = "raise") -> StructType:
    """Envelope fields, then the folder columns, typed so that ``by_entity=007`` stays text."""
    folders = [StructField("by_entity", StringType()), StructField("by_date", DateType())]
    broken = [ORIGIN["corrupt"]] if bad == "keep" else []
    return StructType([*LANDED.fields, *broken, *folders])


def landed_options(bad: str = "raise") -> dict[str, str]:
    if bad not in BAD_LINES:
        raise ValueError(f"bad must be one of {BAD_LINES}")
    return {"mode": "FAILFAST"} if bad == "raise" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}


def with_origin(rows: DataFrame, *more: str) -> DataFrame:
    """The envelope columns of a scan of landed files, the file of each row, and the text of a broken line."""
    corrupt = F.col("corrupt") if "corrupt" in rows.columns else F.lit(None).cast("string")
    return rows.select(*LANDED.names, *more, F.col("_metadata.file_path").alias("source_file"), corrupt.alias("corrupt"))


def land(df: DataFrame, path: str, layout: Sequence[str] = LAYOUT) -> None:
    """Append envelopes as JSON objects.

    The default layout has one folder per date and entity, for reprocessing a single one. With very
    many entities use ``layout=("by_date",)``: the fields are in the objects either way.
    """
    envelopes = df.select(
        iso_utc("ingestion_time").alias("ingestion_time"),
        "entity",
        "days_requested",
        "payload",
        "run_date",
        F.col("entity").alias("by_entity"),
        F.col("run_date").alias("by_date"),
    )
    unused = [c for c in LAYOUT if c not in layout]
    packed = envelopes.drop(*unused).hint("rebalance", *layout)
    packed.write.mode("append").partitionBy(*layout).json(path)


def load_landed(
    spark: SparkSession,
    paths: str | Sequence[str],
    start: date | None = None,
    end: date | None = None,
    base_path: str | None = None,
    bad: str = "raise",
) -> DataFrame:
    """Landed envelopes from one or many files or folders, as one scan.

    Fields outside the schema are ignored and absent ones are null. With ``bad="raise"`` a line that is
    no JSON object, or a value that does not fit its type, fails the job. With ``bad="keep"`` such a
    line becomes a row whose ``corrupt`` holds its text. ``source_file`` names each row's file. The
    folder's ``by_date`` comes along, so that ``landed_between``, here or in a pipeline, reads only the
    folders of its dates.
    """
    reader = spark.read.schema(landed_schema(bad)).options(**landed_options(bad))
    if base_path:
        reader = reader.option("basePath", base_path)
    rows = reader.json([paths] if isinstance(paths, str) else list(paths))
    return landed_between(with_origin(rows, "by_date"), start, end)


def load_landed_days(spark: SparkSession, path: str, start: date, end: date, bad: str = "raise") -> DataFrame:
    """Landed envelopes of the dates from ``start`` to ``end``: no other date's folders are listed.

    For a landing area with the date folders on top, as ``land`` lays it out.
    """
    days = [start + timedelta(days=k) for k in range((end - start).days + 1)]
    found = [folder for day in days for folder in listed(spark, f"{path.rstrip('/')}/by_date={day}")]
    if not found:
        return with_no_rows(spark)
    return load_landed(spark, found, start, end, base_path=path, bad=bad)


def with_no_rows(spark: SparkSession) -> DataFrame:
    fields = [*LANDED.fields, StructField("by_date", DateType()), *ORIGIN.fields]
    return spark.createDataFrame([], StructType(fields))


def landed_between(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Envelopes with a run date in [start, end]; ``None`` leaves a side open."""
    day = F.col("run_date")
    if {"by_date", "corrupt"} <= set(df.columns):
        # A broken line has no run date of its own; its folder decides.
        day = F.when(F.col("corrupt").isNull(), day).otherwise(F.coalesce("run_date", "by_date"))
    for bound, within in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is None:
            continue
        df = df.filter(within(day, F.lit(bound)))
        if "by_date" in df.columns:
            # Files outside a dated folder have no by_date; their run_date decides alone.
            folder_day = F.col("by_date")
            df = df.filter(folder_day.isNull() | within(folder_day, F.lit(bound)))
    return df
