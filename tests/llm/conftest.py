import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) pairs; clash=True adds columns with the operators' own names."""

    def build(*pairs, clash=False):
        rows = [(i, t, "en" if t else None, "a", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCUMENTS)
        if clash:
            from pyspark.sql import functions as F

            for name in ("_id", "_key", "_row", "_doc", "_hash", "_of", "_with", "_copies", "_text_key", "_gone", "_units", "_removed", "component", "print_", "size", "shard", "key", "print", "score", "row", "pieces", "at", "shingle", "start", "ids", "part", "_text", "toxic"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return build


@pytest.fixture(scope="session")
def prose():
    """Deterministic texts of invented words."""

    def make(seed, n):
        rng = random.Random(seed)
        sounds = ["ka", "lo", "mi", "ter", "un", "es", "dra", "pol", "vi", "sha"]
        return " ".join("".join(rng.choice(sounds) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make
