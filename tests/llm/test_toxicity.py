import random

import pytest

from odd_rows import ODD
from tidemark.llm.toxicity import FEATURES, held_out, rates, tokens_of, toxicity, train, unmasked, without_toxic


def test_masks_and_keys():
    assert unmasked("id1ot") == "idiot" and unmasked("s.t.u.p") == "stup" and unmasked("plain,") is None and unmasked("42") is None
    assert tokens_of("Loweischaft,") == ["loweischaft", "lowe*", "lowei*", "loweis*"] and tokens_of("ab") == []


def test_rates_of_a_text():
    lexicon = {"idiot": 4.0, "lowei*": 3.0}
    got = dict(zip(FEATURES, rates("You are an IDIOT! the id1ot loweitum", lexicon, {})))
    assert got["word_hits"] == 1 and got["prefix_hits"] == 1 and got["masked_hits"] == 1
    assert got["near_second_person"] == 2 and got["exclamations"] == pytest.approx(1 / 7)
    assert len(rates("", lexicon, {})) == len(FEATURES)


@pytest.fixture(scope="module")
def corpus(spark, documents, prose):
    rng = random.Random(4)
    pairs, labels = [], []
    for k in range(600):
        words = prose(k, rng.randint(20, 80)).split()
        toxic = k % 5 == 0
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grobword", "nastyone", "vilestuff"]) if k % 2 else "schim" + rng.choice(["pf", "rel", "xo", "ta"]))
        pairs.append((k, " ".join(words)))
        if k % 3:
            labels.append((k, int(toxic)))
    return pairs, spark.createDataFrame([*labels, (5000, 1), (None, 1), (1, None)], "doc_id long, toxic int")


def test_held_out_documents_are_told_apart(documents, corpus):
    pairs, labels = corpus
    rows = toxicity(documents(*pairs, *[(i and i + 1000, t) for i, t in ODD], clash=True), labels).collect()
    assert len(rows) == len(pairs) + len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 600]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert len(held) > 100 and right / len(held) > 0.95


def test_stage_keeps_columns_and_clean_rows(documents, corpus):
    pairs, labels = corpus
    docs = documents(*pairs[:200])
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(k % 5 == 0 for k in ids) <= 4 and sum(k % 5 != 0 for k in ids) >= 155


def test_labels_of_held_out_rows_change_nothing(spark, documents, corpus):
    from pyspark.sql import functions as F

    pairs, labels = corpus
    docs = documents(*pairs)
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity(documents((1, "a"), (2, None)), none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity(documents((1, "a"), (2, None)), one).collect()} <= {0.0, 1.0}
    assert toxicity(documents(), none).count() == 0
    assert train(documents(), none, ~held_out(__import__("pyspark").sql.functions.col("doc_id"))).trees is None
