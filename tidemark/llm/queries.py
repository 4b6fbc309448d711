"""One registered query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, line_dedup, lm, phrases, pieces, pii, ranked, sharding, simhash, token_store, topk, toxicity
from tidemark.llm.common import table


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = token_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"))
    found = store.read(store.locate(docs.select("doc_id")).unionByName(store.unkeyed))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return found.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated runs of lines taken out, and how many lines these were."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.without_repeats(docs).select("doc_id", "text", F.col("_removed").cast("long").alias("n_removed"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), lm.every_seventh(F.col("doc_id")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contaminated(docs, items))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document under merge-dropout, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return encoded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"), shards=40)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ranked.ranked(docs, items, k=50)


ALL = (
    op1_token_store,
    op2_line_dedup,
    op3_lm_scores,
    op4_decontamination,
    op5_personal_data,
    op6_simhash,
    op7_exact_top_k,
    op8_sentencepiece,
    op9_toxicity,
    op10_hilbert_shards,
    op11_collocations,
    op12_language_id,
    op13_lexical_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}
