"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import folder, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder, and the folder.

    A written table cuts the lineage: later jobs reread it after an executor is lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        place, files = folder(spark, path)
        files.delete(place, True)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))
