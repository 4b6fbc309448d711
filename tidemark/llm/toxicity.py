"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon of words and word beginnings is learned from labelled rows; a text becomes a dozen rates:
lexicon densities, lexicon words close to the second person, capitals, punctuation, obfuscation,
length. Trees are boosted on these and an isotonic regression, fitted on rows the trees did not see,
turns their margin into a probability. Features of training rows come from a lexicon that was
learned without them.

Training takes a bounded sample, the ``SAMPLE`` labelled rows with the smallest hash of their id, so
the model's cost does not grow with the table; every row is scored on its whole text.

Defined cases: a null text counts as empty and is scored like it, a very long one counts whole; labels that are null, or that no
document has, are ignored; of several labels of an id the largest counts, of several rows the smallest
text trains;
without both classes among the training rows every score is the share of toxic training rows (0
without any); an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import crc_of_id, dropped, stored, whole

SAMPLE = 12_000
"""Labelled rows that the model learns from, at most."""
LEXICON = 600
"""Entries of each of the two lexicons, at most."""
PREFIXES = (4, 5, 6)
FOLDS = 4
"""Of each FOLDS parts of the sample, one calibrates and the others grow trees."""
TREES, DEPTH = 24, 3
NEAR = 5
"""Words between a lexicon word and the second person, at most, to count as close."""
CACHED = 400_000
"""Words a task remembers before it starts over."""
REJECT = 0.3

# Second-person words of the four languages, and look-alike characters.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

FEATURES = (
    "word_density", "word_hits", "prefix_density", "prefix_hits", "weight_density", "near_second_person",
    "second_person", "capitals", "shouted", "exclamations", "punctuation", "obfuscated", "masked_hits", "log_words",
)
EDGE = ".,;:|()[]{}\"'?!*_-…¿¡«»"


def plain(word: str) -> str:
    """A word in lower case without the signs around it."""
    return word.lower().strip(EDGE)


def unmasked(word: str) -> str | None:
    """The plain word behind look-alike characters or signs put between letters; None if there are none."""
    bare = word.lower().strip(".,;:|()[]{}\"'?")
    if bare.isalpha() or not any(c.isalpha() for c in bare):
        return None
    shown = re.sub(r"[^\w]|_", "", bare.translate(LOOKALIKE))
    return shown if shown and shown != bare else None


def tokens_of(word: str) -> list[str]:
    """The lexicon keys of a word: itself, and its beginnings marked by an asterisk."""
    bare = plain(word)
    if len(bare) < 3:
        return []
    return [bare, *[bare[:n] + "*" for n in PREFIXES if len(bare) > n]]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, key, documents, toxic documents) of a task's rows (fold, toxic, text)."""
    counts: dict[int, tuple[Counter, Counter]] = {}
    keys: dict[str, list[str]] = {}
    for batch in batches:
        for fold, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
            every, bad = counts.setdefault(fold, (Counter(), Counter()))
            found: set[str] = set()
            for word in set(text.split()):
                known = keys.get(word)
                if known is None:
                    known = keys[word] = tokens_of(word)
                found.update(known)
            every.update(found)
            if toxic:
                bad.update(found)
    rows = [(f, k, n, bad[k]) for f, (every, bad) in counts.items() for k, n in every.items()]
    for at in range(0, len(rows), 50_000):
        columns = zip(*rows[at : at + 50_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            ["fold", "key", "n", "bad"],
        )


def learn_lexicon(counts: DataFrame, fold: Column, clean: int, toxic: int) -> dict[str, float]:
    """Log odds of the keys that lean most surely to toxic documents, LEXICON of each kind at most."""
    total = counts.where(fold).groupBy("key").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("bad >= 3")
    odds = F.log(((F.col("bad") + 0.05) / (toxic + 1.0)) / ((F.col("n") - F.col("bad") + 0.5) / (clean + 1.0)))
    ranked = total.select("key", odds.alias("odds"), (odds * F.sqrt(F.col("bad"))).alias("rank")).where("odds > 1.5")
    lexicon: dict[str, float] = {}
    for kind in (F.col("key").endswith("*"), ~F.col("key").endswith("*")):
        best = ranked.where(kind).orderBy(F.desc("rank"), "key").limit(LEXICON)
        lexicon |= {r.key: r.odds for r in best.collect()}
    return lexicon


def facts_of(word: str, lexicon: dict[str, float]) -> tuple:
    """Lexicon weight, weight of its beginnings, weight when unmasked, masked, second person, shouted."""
    hidden = unmasked(word)
    bare = plain(word)
    facts = (
        lexicon.get(bare, 0.0),
        max((lexicon[k] for k in tokens_of(word)[1:] if k in lexicon), default=0.0),
        lexicon.get(hidden, 0.0) if hidden else 0.0,
        hidden is not None,
        bare in SECOND,
        len(word) > 2 and word.isupper(),
    )
    return facts if any(facts) else NOTHING


def rates(text: str, lexicon: dict[str, float], cache: dict[str, tuple]) -> tuple[float, ...]:
    """The dense features of a text, in the order of FEATURES."""
    words = text.split()
    told = []
    for at, word in enumerate(words):
        facts = cache.get(word)
        if facts is None:
            if len(cache) > CACHED:
                cache.clear()
            facts = cache[word] = facts_of(word, lexicon)
        if facts is not NOTHING:
            told.append((at, facts))
    bad = [at for at, f in told if f[0] or f[1] or f[2]]
    person = [at for at, f in told if f[4]]
    near, ahead = 0, 0
    for at in bad:
        while ahead < len(person) and person[ahead] < at - NEAR:
            ahead += 1
        near += ahead < len(person) and person[ahead] <= at + NEAR
    n, raw = max(len(words), 1), text.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    total = lambda k: float(sum(bool(f[k]) for _, f in told))
    return (
        total(0) / n, total(0), total(1) / n, total(1),
        sum(max(f[:3]) for _, f in told) / n, float(near),
        total(4) / n, capitals / max(len(text), 1), total(5) / n,
        text.count("!") / n, sum(map(text.count, ".,;:?|")) / n,
        total(3) / n, total(2), math.log1p(len(words)),
    )


NOTHING = (0.0, 0.0, 0.0, False, False, False)
SECOND = frozenset(SECOND_PERSON.split())


def _features(lexicons: list[dict[str, float]]):
    """Rows (fold, ...kept, text) to the kept columns and one column a feature, by the fold's lexicon."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches: list[dict] = [{} for _ in lexicons]
        for batch in batches:
            found = [
                rates(text, lexicons[fold], caches[fold])
                for fold, text in zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            ]
            columns = list(zip(*found)) or [()] * len(FEATURES)
            kept = batch.columns[1:-1]
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(c, pa.float64()) for c in columns]], [*batch.schema.names[1:-1], *FEATURES]
            )

    return features


_SCHEMA = ", ".join(f"{f} double" for f in FEATURES)


class Model:
    """A fitted lexicon, trees and calibration."""

    def __init__(self, share: float, lexicon: dict[str, float], trees: PipelineModel | None, calibration):
        self.share, self.lexicon, self.trees, self.calibration = share, lexicon, trees, calibration

    def score(self, docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The ``keep`` columns (doc_id by default) as they are in struct row, and score."""
        row = F.struct(*(keep or ["doc_id"])).alias("row")
        if self.trees is None:
            return docs.select(row, F.lit(self.share).alias("score"))
        rows = docs.select(F.lit(0).alias("fold"), row, whole(F.col("text").cast("string")).alias("text"))
        schema = StructType([rows.schema["row"], *[StructField(f, DoubleType()) for f in FEATURES]])
        scored = self.trees.transform(rows.mapInArrow(_features([self.lexicon]), schema))
        scored = self.calibration.transform(_margin(scored))
        return scored.select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction"))).alias("score"))


def _margin(df: DataFrame) -> DataFrame:
    return df.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("prediction", "probability", "rawPrediction")


def train(docs: DataFrame, labels: DataFrame, may_learn: Column) -> Model:
    """Fit on the sample of labelled ``docs`` whose ids satisfy ``may_learn`` (a column over doc_id)."""
    spark = docs.sparkSession
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & may_learn)
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.join(docs.select("doc_id"), "doc_id", "left_semi")
    told, told_path = stored(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "labelled")
    texts = docs.select("doc_id", whole(F.col("text").cast("string")).alias("text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    rows = texts.join(F.broadcast(told), "doc_id")  # SAMPLE ids at most
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows, rows_path = stored(rows.select(fold, "doc_id", "toxic", "text").repartition(spark.sparkContext.defaultParallelism), "sample")
    per_fold = {r.fold: (r.n - r.bad, r.bad) for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).collect()}
    clean, toxic = (sum(x[k] for x in per_fold.values()) for k in (0, 1))
    if not clean or not toxic:
        dropped(spark, told_path, rows_path)
        return Model(toxic / max(clean + toxic, 1), {}, None, None)
    counts, counts_path = stored(
        rows.select("fold", "toxic", "text").mapInArrow(_document_counts, "fold int, key string, n long, bad long")
        .groupBy("fold", "key").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")),
        "words",
    )
    lexicons = []
    for k in range(FOLDS):
        c, t = per_fold.get(k, (0, 0))
        lexicons.append(learn_lexicon(counts, F.col("fold") != k, clean - c, toxic - t))
    features, features_path = stored(
        rows.select("fold", F.col("fold").alias("part"), "toxic", "text").mapInArrow(_features(lexicons), f"part int, toxic int, {_SCHEMA}"),
        "features",
    )
    grows = features.where(F.col("part") != 0)
    two = grows.select("toxic").distinct().count() == 2
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, maxBins=64)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fitted = PipelineModel([assembled, trees.fit(assembled.transform(grows if two else features))])
    held = features.where(F.col("part") == 0)
    held = held if held.select("toxic").distinct().count() == 2 else features
    # Many rows have the same margin: they count by weight, or one task would get them all.
    margins = _margin(fitted.transform(held)).groupBy("margin", F.col("toxic").cast("double").alias("label"))
    margins = margins.agg(F.count(F.lit(1)).cast("double").alias("weight"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight").fit(margins)
    lexicon = learn_lexicon(counts, F.lit(True), clean, toxic)
    dropped(spark, told_path, rows_path, counts_path, features_path)
    return Model(toxic / (clean + toxic), lexicon, fitted, calibration)


def held_out(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 4 == 2


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below REJECT."""
    scored = train(docs, labels, ~held_out(F.col("doc_id"))).score(docs, docs.columns)
    return scored.where(F.col("score") < REJECT).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = train(docs, labels, ~held_out(F.col("doc_id"))).score(docs)
    return scored.select(F.col("row.doc_id"), "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= REJECT, 1).otherwise(0).alias("predicted"),
    )
