"""Documents to training text: five stages, each written as Parquet and reread by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. Nulls, empty texts, repeated rows and further columns behave as the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from tidemark.llm.common import dropped, stored, table

#: Trained models decide in the first stage, so SQL cannot express the rows.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the runs of lines that an earlier place holds."""
    out = line_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(out.columns[-1]) > 0, length).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with the pieces of each text, in place of columns of these names; text is what they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    kept = [c for c in docs.columns if c not in ("pieces", "lossless", "decoded")]
    out = pieces.encode_pieces(docs, model, keep=[c for c in kept if c != "text"], decoded=True)
    return out.withColumnRenamed("decoded", "text").select(*kept, "pieces", "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            dropped(spark, before)  # the next stage reads this one's rows alone
        before = path
    return docs
