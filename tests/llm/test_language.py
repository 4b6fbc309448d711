import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.language import ORDER, Model, calibrated, entropies, held_out, languages, learned, letters, train

SOUNDS = {"aa": "ka lo mi ter un", "bb": "sch wur ge heit ung", "cc": "eau oir que é ç"}


def speech(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SOUNDS[lang].split()) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(k, speech(lang, k, 3 + k % 60), lang, "web") for k, lang in enumerate(list(SOUNDS) * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def brute_model(texts):
    """Kneser-Ney by dictionaries: the probability of a character after a string, straight from the definition."""
    grams = Counter()
    for t in texts:
        padded = " " * (ORDER - 1) + t
        grams.update(padded[k : k + ORDER] for k in range(len(t)))
    levels = {ORDER: grams}
    for n in range(ORDER - 1, 0, -1):
        before = defaultdict(set)
        for g in levels[n + 1]:
            before[g[1:]].add(g[0])
        levels[n] = Counter({g: len(s) for g, s in before.items()})
    facts = {}
    for n, counts in levels.items():
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        total, kinds = Counter(), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        facts[n] = (min(max(once / max(once + 2 * twice, 1), 0.05), 0.95), total, kinds)

    def p(gram):
        if not gram:
            return 1 / 0x110000
        discount, total, kinds = facts[len(gram)]
        context = gram[:-1]
        if context not in total:
            return p(gram[1:])
        return max(levels[len(gram)][gram] - discount, 0) / total[context] + discount * kinds[context] / total[context] * p(gram[1:])

    return p


def as_text(codes):
    return "".join(map(chr, codes))


def test_letters():
    assert as_text(letters("  Ab,c 12 É\n")) == "ab c é "
    assert len(letters(None)) == len(letters("12 -- ²")) == 0
    assert as_text(letters("x1y")) == "x y "


def test_entropies_match_the_definition(monkeypatch):
    monkeypatch.setattr(language, "PIECE", 64)  # so that texts lie across pieces
    texts = [as_text(letters(speech("aa", k, 20))) for k in range(12)]
    model = learned([letters(t) for t in texts])
    p = brute_model(texts)
    asked = [*texts[:2], as_text(letters(speech("bb", 1, 30))), "ka ", "z ", "kalomi xyz öö ", as_text(letters(speech("aa", 99, 40)))]
    got = entropies([letters(t) for t in asked], [model, Model.unpacked(model.packed())]) / language.STEP
    for t, row in zip(asked, got):
        padded = " " * (ORDER - 1) + t
        want = sum(-math.log2(p(padded[k : k + ORDER])) for k in range(len(t)))
        assert row[0] == row[1] == pytest.approx(want, abs=1e-4 * len(t))


def test_probabilities_after_a_context_stay_under_one():
    texts = [as_text(letters(speech("cc", k, 30))) for k in range(5)]
    model = learned([letters(t) for t in texts])
    alphabet = sorted(set("".join(texts)))
    context = texts[0][:8]
    base = entropies([letters(context[:-1] + " ")], [model])[0, 0]
    codes = [np.frombuffer((context + c).encode("utf-32-le"), np.uint32) for c in alphabet]
    alone = entropies([np.frombuffer(context.encode("utf-32-le"), np.uint32)], [model])[0, 0]
    p = 2.0 ** (-(entropies(codes, [model])[:, 0] - alone) / language.STEP)
    assert 0.99 < p.sum() <= 1.0001 and base > 0


def test_languages_are_told_apart(spoken):
    rows = languages(spoken).collect()
    lang = {r.doc_id: r.lang for r in spoken.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == 180 and held and all(r.lang_pred == lang[r.doc_id] for r in held)
    assert all(0.5 < r.score <= 1 for r in rows) and sum(r.accepted for r in rows) > 170


def test_held_out_rows_lang_source_and_id_decide_nothing(spoken):
    fitted = train(spoken, ~held_out(F.col("doc_id")))
    again = spoken.withColumn("lang", F.when(~held_out(F.col("doc_id")), F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    moved = train(again, ~held_out(F.col("doc_id")))
    one = fitted.predict(spoken, F.col("text")).collect()
    other = moved.predict(again.withColumn("doc_id", -F.col("doc_id")), F.col("text")).collect()
    assert sorted(one) == sorted(other)


def test_foreign_text_is_not_accepted(spark, spoken):
    fitted = train(spoken, F.lit(True))
    odd = spark.createDataFrame([("жщ" * 40 + " " + "цф" * 30,), ("qxzw vvjj " * 20,), (speech("bb", 7777, 50),)], "text string")
    got = {r.text[:2]: r for r in fitted.predict(odd, F.col("text")).collect()}
    assert not got["жщ"].accepted and not got["qx"].accepted
    theirs = [r for k, r in got.items() if k not in ("жщ", "qx")][0]
    assert theirs.accepted and theirs.lang_pred == "bb"


def test_odd_rows_and_clashing_columns(documents, spoken):
    odd = documents(*ODD, (9, "12 34 !"), clash=True).withColumn("row", F.lit("x")).withColumn("accepted", F.lit("x")).withColumn("lang_pred", F.lit("x"))
    got = languages(odd.withColumn("lang", F.lit("aa"))).collect()
    assert len(got) == len(ODD) + 1
    by = {r.doc_id: (r.lang_pred, r.score, r.bits_per_char) for r in got}
    assert by[1] == by[2] == by[3] == by[9] == ("und", 0.0, None)
    assert by[None][0] == by[4][0] == "aa" and sum(r.doc_id == 4 for r in got) == 3


def test_nothing_to_learn_from(documents):
    assert languages(documents()).count() == 0
    unlabelled = documents((1, "some words"), (2, None)).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score, r.accepted) for r in languages(unlabelled).collect()} == {("und", 0.0, False)}


def test_a_very_long_text_counts_whole(spark, spoken):
    # The first third looks like aa, the rest is bb.
    text = speech("aa", 1, 60_000) + " " + speech("bb", 2, 150_000)
    assert len(text) > language.PIECE
    long = spark.createDataFrame([(text,)], "text string")
    row = train(spoken, F.lit(True)).predict(long, F.length("text").alias("n")).first()
    assert (row.n, row.lang_pred) == (len(text), "bb")


def test_the_sample_is_bounded_and_takes_copies_once(monkeypatch, spark):
    monkeypatch.setattr(language, "SAMPLE", 30)
    rows = [(k, speech("aa", 0, 40) if k % 2 else speech("aa", k, 40), "aa") for k in range(400)]
    rows += [(k, speech("bb", k, 40), "bb") for k in range(400, 440)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language, "dropped", lambda spark, *paths: seen.append(spark.read.parquet(paths[1]).collect()))
    train(docs, F.lit(True))
    per = Counter(r.lang for r in seen[0])
    assert set(per) == {"aa", "bb"} and max(per.values()) <= 30 and per["bb"] == 30
    assert len({r.text for r in seen[0]}) == len(seen[0])


def test_calibration_follows_the_lead():
    rng = np.random.default_rng(1)
    lead = rng.exponential(2, 4000)
    right = rng.random(4000) < 1 / (1 + np.exp(-(0.2 + 1.1 * lead)))
    fitted = calibrated(np.array(["aa"] * 4000), right, lead, np.full(4000, 9), np.ones(4000))
    assert fitted.slope == pytest.approx(1.1, abs=0.15) and fitted.offset == pytest.approx(0.2, abs=0.2)
    score = fitted.score(lead)
    assert right[score >= fitted.threshold].mean() >= language.TRUSTED - 1e-9
    assert not fitted.accepts("aa", 1.0, 9, 1.5) and fitted.accepts("aa", 1.0, 9, 1.0)
