"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

A text becomes lower-case letters with single blanks between words. The model of a language gives
each character a probability from the ``ORDER - 1`` characters before it:

    p(c | h) = max(count(h c) - D, 0) / count(h) + D * kinds(h) / count(h) * p(c | h without its first)

with the usual continuation counts below the highest order, one discount D = n1 / (n1 + 2 n2) an
order, and a uniform share over all code points at the bottom. Probabilities are stored as whole
1/65536 bits beside the sorted 64-bit hashes of their character sequences, so sums do not depend on
how rows are dealt. The language with the fewest bits a character is chosen.

Rejection is calibrated on texts the models did not see, whole and in cuts of several lengths. The
score is the chance that the choice is right, a logistic function of the lead over the second
language times the root of the length. A choice is ``accepted`` when its score reaches the lowest
value from which on ``TRUSTED`` of the calibration cuts were right, and when its bits a character stay
under the language's ceiling for that length, the quantile ``USUAL`` of right choices.

Models learn from a bounded sample: for each language the ``SAMPLE`` distinct texts with the smallest
hash, as far as they hold ``CHARS`` characters together (``TOTAL`` over all languages). All rows are
predicted, on their whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text when
nothing was learned; equal entropies go to the smaller language; with a single language the score of
a text is the calibrated chance at a lead of zero; a null lang teaches nothing; a text longer than
``CHARS`` is predicted like any other but teaches nothing; repeated rows count once in the sample and
are predicted each; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc_of_id, dropped, stored, whole

ORDER = 5
SAMPLE = 2000
"""Texts that a language is learned from, at most."""
CHARS = 2_000_000
TOTAL = 80_000_000
"""Characters of the sample over all languages, at most twice over."""
CALIBRATE = 5
"""Of so many parts of the sample, one calibrates and the others teach."""
CUTS = (4, 8, 16, 32, 64, 128, 256, 512)
"""Lengths of the cuts that calibrate, besides whole texts."""
TRUSTED = 0.99
USUAL = 0.999
STEP = 65536
"""Parts of a bit."""
PIECE = 1 << 20
"""Characters that are looked up at once."""
UNKNOWN = "und"
CODE_POINTS = 0x110000
_NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-case words of a text, a blank between and behind them; empty without a letter."""
    text = text or ""
    if not any(map(str.isalpha, text)):
        return np.empty(0, np.uint32)
    plain = _NO_LETTER.sub(" ", text.lower()).strip() + " "
    return np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)


def keys(codes: np.ndarray, at: np.ndarray | slice, n: int, back: int = 0) -> np.ndarray:
    """Hashes of the ``n`` codes that end ``back`` before each position of ``at``."""
    with np.errstate(over="ignore"):
        out = None
        for k in range(n):
            where = slice(at.start - back - k, at.stop - back - k) if isinstance(at, slice) else at - (back + k)
            code = codes[where].astype(np.uint64) + np.uint64(1)
            out = code * np.uint64(0x9E3779B97F4A7C15) if out is None else (out ^ code) * np.uint64(0xBF58476D1CE4E5B9)
            out = out ^ (out >> np.uint64(29))
        return out


def bits(p: np.ndarray) -> np.ndarray:
    return np.round(-np.log2(p) * STEP).astype(np.int32)


def look_up(known: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``asked`` are in the sorted array, and the values of those."""
    if not len(known):
        return np.zeros(len(asked), bool), values[:0]
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[at] == asked
    return hit, values[at[hit]]


@dataclass
class Model:
    """Sorted hashes and costs of one language: sequences and contexts of each order, the empty context."""

    sequences: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    unseen: int = 0

    def costs(self, codes: np.ndarray, at: np.ndarray, top: np.ndarray) -> np.ndarray:
        """1/65536 bits of the codes at ``at``, whose sequences of the highest order hash to ``top`` (sorted)."""
        out, left = np.zeros(len(at), np.int64), np.arange(len(at))
        for n in range(ORDER, 0, -1):
            hit, cost = look_up(*self.sequences[n - 1], top if n == ORDER else keys(codes, at[left], n))
            out[left[hit]] += cost
            left = left[~hit]
            if not len(left):
                return out
            if n > 1:
                hit, cost = look_up(*self.contexts[n - 1], keys(codes, at[left], n - 1, back=1))
                out[left[hit]] += cost
        out[left] += self.unseen
        return out

    def packed(self) -> list[bytes]:
        parts = [x for pair in (*self.sequences, *self.contexts) for x in pair]
        return [*(p.tobytes() for p in parts), np.int64(self.unseen).tobytes()]

    @staticmethod
    def unpacked(parts: list[bytes]) -> Model:
        arrays = [np.frombuffer(p, np.uint64 if k % 2 == 0 else np.int32) for k, p in enumerate(parts[:-1])]
        pairs = list(zip(arrays[::2], arrays[1::2]))
        return Model(pairs[:ORDER], pairs[ORDER:], int(np.frombuffer(parts[-1], np.int64)[0]))


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each behind ORDER - 1 blanks, and where each one starts."""
    pad = np.full(ORDER - 1, 32, np.uint32)
    sizes = np.array([len(t) + ORDER - 1 for t in texts], np.int64)
    return np.concatenate([x for t in texts for x in (pad, t)]), np.cumsum(sizes) - sizes


def learned(texts: list[np.ndarray]) -> Model:
    """The Kneser-Ney model of some texts."""
    codes, starts = laid_out(texts)
    at = np.concatenate([np.arange(s + ORDER - 1, s + ORDER - 1 + len(t)) for s, t in zip(starts, texts)])
    kinds: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    hashes, first, counts = np.unique(keys(codes, at, ORDER), return_index=True, return_counts=True)
    kinds.append((hashes, at[first], counts))
    for n in range(ORDER - 1, 0, -1):  # how many different characters stand before a shorter sequence
        longer = kinds[-1][1]
        hashes, first, counts = np.unique(keys(codes, longer, n), return_index=True, return_counts=True)
        kinds.append((hashes, longer[first], counts))
    model, below, below_keys = Model(), None, None
    for n, (hashes, where, counts) in enumerate(reversed(kinds), 1):
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        discount = min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)
        context = keys(codes, where, n - 1, back=1) if n > 1 else np.zeros(len(where), np.uint64)
        contexts, of = np.unique(context, return_inverse=True)
        total = np.bincount(of, weights=counts)
        share = discount * np.bincount(of) / total
        if n == 1:
            lower = np.full(len(hashes), 1 / CODE_POINTS)
            model.unseen = int(bits(share[:1] / CODE_POINTS)[0])
        else:
            lower = below[np.searchsorted(below_keys, keys(codes, where, n - 1))]
        below, below_keys = (counts - discount) / total[of] + share[of] * lower, hashes
        model.sequences.append((hashes, bits(below)))
        model.contexts.append((contexts, bits(share)))
    return model


def entropies(texts: list[np.ndarray], models: list[Model]) -> np.ndarray:
    """1/65536 bits of each text (rows) under each model (columns), summed over its characters."""
    codes, starts = laid_out(texts)
    out = np.zeros((len(texts), len(models)), np.int64)
    ends = starts + ORDER - 1 + np.array([len(t) for t in texts], np.int64)
    for low in range(ORDER - 1, len(codes), PIECE):
        piece = slice(low, min(low + PIECE, len(codes)))
        top, first, again = np.unique(keys(codes, piece, ORDER), return_index=True, return_inverse=True)
        a, b = np.searchsorted(ends, piece.start, "right"), np.searchsorted(starts + ORDER - 1, piece.stop, "left")
        from_ = np.maximum(starts[a:b] + ORDER - 1, piece.start) - piece.start
        to = np.minimum(ends[a:b], piece.stop) - piece.start
        for k, model in enumerate(models):
            summed = np.concatenate([[0], np.cumsum(model.costs(codes, first + piece.start, top)[again])])
            out[a:b, k] += summed[to] - summed[from_]
    return out


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    texts = [t for t in map(letters, rows["text"]) if len(t)]
    parts = learned(texts).packed() if texts else []
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "parts": [parts]})


def _cuts(batches: Iterator[pa.RecordBatch], models, langs: list[str]) -> Iterator[pa.RecordBatch]:
    """(lang, whether the choice was right, lead, length, bits a character) of calibration texts and their cuts."""
    for batch in batches:
        found = []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = letters(text)
            found += [(lang, codes)] if len(codes) else []
            found += [(lang, codes[len(codes) // 3 :][:n]) for n in CUTS if len(codes) // 3 + n <= len(codes)]
        if not found:
            continue
        best, lead, per = choices([t for _, t in found], models)
        yield pa.RecordBatch.from_arrays(
            [pa.array([l for l, _ in found]), pa.array([langs[b] == l for b, (l, _) in zip(best, found)]), pa.array(lead),
             pa.array([len(t) for _, t in found], pa.int64()), pa.array(per)],
            ["lang", "right", "lead", "length", "per"],
        )


def choices(texts: list[np.ndarray], models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the best model, its lead times the root of the length, its bits a character."""
    length = np.array([len(t) for t in texts], np.float64)
    per = entropies(texts, models) / STEP / length[:, None]
    best = per.argmin(axis=1)
    ordered = np.sort(per, axis=1)
    lead = (ordered[:, 1] - ordered[:, 0]) * np.sqrt(length) if per.shape[1] > 1 else np.zeros(len(texts))
    return best, lead, ordered[:, 0]


@dataclass
class Calibration:
    offset: float
    slope: float
    threshold: float
    ceilings: dict[str, list[float]]

    def score(self, lead: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * lead, -30, 30)))

    def accepts(self, lang: str, score: float, length: int, per: float) -> bool:
        ceiling = self.ceilings.get(lang)
        return score >= self.threshold and (ceiling is None or per <= ceiling[length_class(length)])


def length_class(length: int) -> int:
    return int(np.searchsorted(CUTS, length, "right"))


def calibrated(lang: np.ndarray, right: np.ndarray, lead: np.ndarray, length: np.ndarray, per: np.ndarray) -> Calibration:
    """Logistic chance of being right given the lead, by Newton steps on smoothed targets; threshold and ceilings."""
    if not len(right):
        return Calibration(0.0, 1.0, 0.0, {})
    good, bad = int(right.sum()), int((~right).sum())
    target = np.where(right, (good + 1) / (good + 2), 1 / (bad + 2))
    x, weights = np.column_stack([np.ones(len(lead)), lead]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (target - p) - 1e-6 * weights)
        weights = weights + np.clip(step, -2, 2)
    weights[1] = max(weights[1], 1e-3)
    out = Calibration(float(weights[0]), float(weights[1]), 0.0, {})
    score = out.score(lead)
    order = np.argsort(-score, kind="stable")
    precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    trusted = np.flatnonzero(precision >= TRUSTED)
    out.threshold = float(score[order][trusted[-1]]) if len(trusted) else 1.0
    classes = np.array([length_class(n) for n in length])
    for name in np.unique(lang[right]):
        mine = right & (lang == name)
        usual = [np.quantile(per[mine & (classes == c)], USUAL) if (mine & (classes == c)).any() else np.nan for c in range(len(CUTS) + 1)]
        highest = float(per[mine].max())
        out.ceilings[str(name)] = [highest if np.isnan(u) else float(u) for u in usual]
    return out


@dataclass
class Identifier:
    """Fitted models by language, and their calibration."""

    langs: list[str]
    models: list[Model]
    calibration: Calibration

    def predict(self, docs: DataFrame, *keep: Column) -> DataFrame:
        """The ``keep`` columns, lang_pred, score, accepted and bits_per_char of every row of ``docs``."""
        rows = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
        shared = docs.sparkSession.sparkContext.broadcast((self.langs, [m.packed() for m in self.models], self.calibration))
        schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, accepted boolean, bits_per_char double"
        scored = rows.mapInArrow(lambda batches: _predicted(batches, shared), schema)
        return scored.select("row.*", "lang_pred", "score", "accepted", "bits_per_char")


def _predicted(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    langs, parts, calibration = shared.value
    models = [Model.unpacked(p) for p in parts]
    for batch in batches:
        texts = batch.column(1)
        found: list[tuple] = [(UNKNOWN, 0.0, False, None)] * batch.num_rows
        held: list[tuple[int, np.ndarray]] = []

        def flush():
            if not held:
                return
            best, lead, per = choices([t for _, t in held], models)
            for (at, codes), b, s, h in zip(held, best, calibration.score(lead), per):
                found[at] = (langs[b], float(s), calibration.accepts(langs[b], s, len(codes), h), float(h))
            held.clear()

        size = 0
        for at in range(batch.num_rows if models else 0):
            codes = letters(texts[at].as_py())
            if len(codes):
                held.append((at, codes))
                size += len(codes)
            if size >= PIECE:
                flush()
                size = 0
        flush()
        kinds = (pa.string(), pa.float64(), pa.bool_(), pa.float64())
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "lang_pred", "score", "accepted", "bits_per_char"])


def train(docs: DataFrame, may_learn: Column) -> Identifier:
    """Learn from the sample of ``docs`` with a lang whose ids satisfy ``may_learn``."""
    spark = docs.sparkSession
    rows = docs.where(F.col("lang").isNotNull() & may_learn).select(
        F.col("lang").cast("string").alias("lang"), whole(F.col("text").cast("string")).alias("text")
    )
    # So many of a million hash classes hold half as many texts again as the sample needs, whatever the table's size.
    sizes, sizes_path = stored(
        rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
        .select("lang", F.least(F.lit(1_000_000), F.ceil(1_500_000 * SAMPLE / F.col("rows")) + 1).alias("classes")), "langs",
    )
    chars = min(CHARS, TOTAL // max(sizes.count(), 1))
    lang_of = F.col("lang") == F.col("_lang")
    near = rows.join(sizes.withColumnRenamed("lang", "_lang"), lang_of).withColumn("key", F.xxhash64("text"))
    near = near.where((F.pmod("key", F.lit(1_000_000)) < F.col("classes")) & (F.length("text") <= chars))
    # Copies meet in the map tasks; one of each text goes on.
    once = near.groupBy("lang", "key").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1_000_000)), "key")
    before = F.coalesce(F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = once.select("lang", "key", "text", F.row_number().over(order).alias("at"), before.alias("before"))
    sample, path = stored(ranked.where((F.col("at") <= SAMPLE) & (F.col("before") < chars)).select("lang", "key", "text"), "lang-sample")
    calibrates = F.pmod("key", F.lit(CALIBRATE)) == 0
    fitted = sample.where(~calibrates).groupBy("lang").applyInPandas(_fit, "lang string, parts array<binary>")
    found = sorted((r.lang, r.parts) for r in fitted.collect() if r.parts)  # bounded by the sample
    langs, models = [l for l, _ in found], [Model.unpacked(p) for _, p in found]
    calibration = Calibration(0.0, 1.0, 0.0, {})
    if models:
        shared = spark.sparkContext.broadcast((langs, [m.packed() for m in models]))

        def cuts(batches):
            names, parts = shared.value
            return _cuts(batches, [Model.unpacked(p) for p in parts], names)

        held = sample.where(calibrates & F.col("lang").isin(langs)).select("lang", "text")
        schema = "lang string, right boolean, lead double, length long, per double"
        told = held.mapInArrow(cuts, schema).orderBy("lang", "length", "per", "lead").collect()  # some rows for each text of the sample
        columns = [np.array([r[k] for r in told]) for k in range(5)]
        calibration = calibrated(columns[0], columns[1].astype(bool), *columns[2:])
    dropped(spark, sizes_path, path)
    return Identifier(langs, models, calibration)


def held_out(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 4 == 2


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted and bits_per_char of every row."""
    identifier = train(docs, ~held_out(F.col("doc_id")))
    return identifier.predict(docs, F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"))
