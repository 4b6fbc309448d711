"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of a word given the word before it, of the word alone,
and a uniform share for words never seen:

    p(w | v) = l[b] * c(v w) / c(v) + (1 - l[b]) * (m * c(w) / N + (1 - m) / (V + 1))

with one weight l[b] for each bucket b of the context's frequency c(v), in powers of two. The weights
are learned by expectation-maximisation on held-out counts: each training token in turn is taken out
of all counts (c - 1) and predicted from the rest, and lands in the bucket of the reduced frequency.
For a fixed m an EM step needs only how the ratio of the two estimates is distributed in a bucket, so
tasks return histograms over (bucket, logarithm of the ratio) of fixed size.

Words and word pairs are known by 64-bit hashes. Texts are read once, into blocks of about a million
tokens stored in the shared folder. A block asks for the counts of its distinct words and pairs: one
sorted, compressed list of hashes for each range of hashes. The owner of a range adds up what all
blocks hold and answers each list in its order. A word that a third of all documents hold is one
entry in each block's list.

Defined cases: a null text counts as empty and is its end token alone; a very long text is a block of
its own; a null doc_id counts as empty
text in the fold rule; repeated rows are separate documents; without training tokens every
probability is 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_of_id, dropped, stored, whole
from tidemark.llm.token_store import runs

BLOCK = 1_000_000
"""Tokens of a block; a longer text is a block of its own."""
RANGE = 1_500_000
"""Tokens of the corpus for each range of hashes."""
TOGETHER = 100_000
"""Hashes that a block asks for at once, about."""
BINS = 16
"""Histogram bins for each doubling of the ratio of the two estimates."""
LOWEST, HIGHEST = -40, 80
BUCKETS = 48
ROUNDS = 60
END = 0
"""Local number of the end token in every block."""

BLOCKS = "block string, doc_ids array<bigint>, held_out array<boolean>, sizes array<bigint>, n long, words binary, tokens binary"
WORD, PAIR = 1, 2


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes of equal weight side by side, compressed."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return pa.compress(np.ascontiguousarray(flat.T).tobytes(), "zstd", asbytes=True)


def unsqueezed(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data, n * width, "zstd", asbytes=True), np.uint8) if n else np.empty(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).reshape(n)


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = before * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(29))


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, cut at white space of ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number: dict[bytes, int] = {}
    docs: list[tuple] = []
    tokens: list[np.ndarray] = []

    def block():
        names = list(number)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in names), np.uint64, len(names))
        ids, held, sizes = zip(*docs)
        flat = np.concatenate(tokens)
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([len(names)], pa.int64()),
             pa.array([squeezed(hashes)], pa.binary()), pa.array([squeezed(flat)], pa.binary())],
            ["block", "doc_ids", "held_out", "sizes", "n", "words", "tokens"],
        )

    total = 0
    number[b""] = END  # no word is empty
    for batch in batches:
        for doc_id, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = words_of(text.as_py())
            if docs and total + len(words) >= BLOCK:
                yield block()
                number, docs[:], tokens[:], total = {b"": END}, [], [], 0
            for word in set(words):
                number.setdefault(word, len(number))
            tokens.append(np.fromiter((*map(number.__getitem__, words), END), np.uint32, len(words) + 1))
            docs.append((doc_id, held, len(words) + 1))
            total += len(words) + 1
    if docs:
        yield block()


class Block:
    """One block: its documents, tokens, and distinct words and pairs in the order of their hashes."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], np.int64)
        self.doc_ids, self.held_out = row["doc_ids"], np.array(row["held_out"], bool)
        hashes = unsqueezed(row["words"], row["n"], "<u8")
        self.tokens = unsqueezed(row["tokens"], int(self.sizes.sum()), "<u4").astype(np.int64)
        self.training = np.repeat(~self.held_out, self.sizes)
        # Each document starts after an end token.
        self.before = np.concatenate([[END], self.tokens[:-1]])
        pairs, self.pair_of = np.unique(self.before << 32 | self.tokens, return_inverse=True)
        pair_hashes = pair_hash(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])
        self.orders = {WORD: np.argsort(hashes, kind="stable"), PAIR: np.argsort(pair_hashes, kind="stable")}
        self.hashes = {WORD: hashes, PAIR: pair_hashes}
        self.at = {WORD: self.tokens, PAIR: self.pair_of}

    def questions(self, ranges: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(kind, range, sorted hashes, training counts) for each range of hashes."""
        for kind in (WORD, PAIR):
            order = self.orders[kind]
            hashes = self.hashes[kind][order]
            counts = np.bincount(self.at[kind][self.training], minlength=len(hashes))[order]
            owner = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            # Only ranges that the block has hashes of: there may be far more ranges than hashes.
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(owner)]):
                yield kind, int(owner[a]), hashes[a:b], counts[a:b]

    def take(self, answers: dict[int, np.ndarray]) -> None:
        """Counts in the corpus of each token, its predecessor and their pair; answers in the order of the questions."""
        counts = {}
        for kind, order in self.orders.items():
            counts[kind] = np.empty(len(order), np.int64)
            counts[kind][order] = answers[kind]
        self.word, self.context = counts[WORD][self.tokens], counts[WORD][self.before]
        self.pair = counts[PAIR][self.pair_of]


def _questions(ranges: int):
    names, kinds = ["owner", "block", "n", "steps", "counts"], (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for kind, k, hashes, counts in Block(row).questions(ranges):
                    steps = np.diff(hashes, prepend=np.uint64(0))
                    held.append((kind << 32 | k, row["block"], len(hashes), squeezed(steps), squeezed(counts.astype("<u4"))))
                    size += len(hashes)
                    if size >= TOGETHER:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    return ask


def frequency_bin(count: np.ndarray) -> np.ndarray:
    """Counts up to 1000 as they are, larger ones in steps of about one percent."""
    large = 1000 + np.floor(np.log(np.maximum(count, 1) / 1000.0) * 100).astype(np.int64)
    return np.where(count <= 1000, count, np.maximum(large, 1001))


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the lists of each owner and answer them; the words' count frequencies go along."""
    for owner, part in runs(batches):
        rows = part.select(["block", "n", "steps", "counts"]).to_pylist()
        hashes = [np.cumsum(unsqueezed(r["steps"], r["n"], "<u8"), dtype=np.uint64) for r in rows]
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([unsqueezed(r["counts"], r["n"], "<u4") for r in rows])
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        seen = total[total > 0] if owner >> 32 == WORD else total[:0]
        bins, where = np.unique(frequency_bin(seen), return_inverse=True)
        frequencies = [np.bincount(where, minlength=len(bins)), np.bincount(where, weights=seen, minlength=len(bins)).astype(np.int64)]
        at = np.split(at, np.cumsum([r["n"] for r in rows])[:-1])
        for k, (row, mine) in enumerate(zip(rows, at)):
            told = [bins, *frequencies] if k == 0 else [bins[:0]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]]), pa.array([owner]), pa.array([row["n"]], pa.int64()), pa.array([squeezed(total[mine])], pa.binary()),
                 *[pa.array([x.tolist()], pa.list_(pa.int64())) for x in told]],
                ["block", "owner", "n", "counts", "bins", "bin_words", "bin_tokens"],
            )


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks with their answers, from rows sorted by block and owner; the block's own row has owner -1."""
    for _, part in runs(batches):
        block, answers = None, {WORD: [], PAIR: []}
        for row in part.to_pylist():
            if row["owner"] < 0:
                block = Block(row)
            else:
                answers[row["owner"] >> 32].append(unsqueezed(row["counts"], row["n"], "<i8"))
        block.take({kind: np.concatenate(x) for kind, x in answers.items()})
        yield block


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.where(context > 0, np.minimum(np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, BUCKETS - 1), 0)


class Estimates:
    """N, V and the mixture weights."""

    def __init__(self, n: int, v: int, known: float, weights: np.ndarray):
        self.n, self.v, self.known, self.weights = n, v, known, weights

    def alone(self, count: np.ndarray, less: int = 0) -> np.ndarray:
        """Probability of a word by itself, with ``less`` occurrences taken out."""
        return self.known * (count - less) / max(self.n - less, 1) + (1 - self.known) / (self.v + 1)

    def log10(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        weight = self.weights[bucket_of(context)]
        return np.log10(weight * pair / np.maximum(context, 1) + (1 - weight) * self.alone(word))


def learn_known(n: int, v: int, count: np.ndarray, tokens: np.ndarray) -> float:
    """Weight of the word counts against the uniform share, by EM over tokens taken out one at a time."""
    if not n:
        return 0.0
    known, reduced, uniform = 0.9, (count - 1) / max(n - 1, 1), 1 / (v + 1)
    for _ in range(ROUNDS):
        mine = known * reduced
        known = float((tokens * mine / (mine + (1 - known) * uniform)).sum() / tokens.sum())
        known = min(max(known, 1e-6), 1 - 1e-6)
    return known


def learn_weights(bucket: np.ndarray, bin_: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weight of the pair estimate in each bucket, by EM over the histogram of ratios."""
    weights = np.full(BUCKETS, np.nan)
    weights[0] = 0.0
    for b in np.unique(bucket[bucket > 0]):
        mine = bucket == b
        ratio = np.where(bin_[mine] == LOWEST * BINS - 1, 0.0, 2.0 ** ((bin_[mine] + 0.5) / BINS))
        tokens, weight = n[mine].astype(float), 0.5
        for _ in range(ROUNDS):
            weight = float((tokens * weight * ratio / (weight * ratio + 1 - weight)).sum() / tokens.sum())
            weight = min(max(weight, 1e-6), 1 - 1e-6)
        weights[b] = weight
    for b in range(1, BUCKETS):  # a bucket without tokens takes the weight below it
        if np.isnan(weights[b]):
            weights[b] = weights[b - 1]
    return weights


def _histograms(estimates: Estimates):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _answered(batches):
            use = block.training & (block.context > 1)
            context = block.context[use] - 1
            ratio = (block.pair[use] - 1) / context / estimates.alone(block.word[use], 1)
            with np.errstate(divide="ignore"):
                place = np.floor(np.log2(ratio) * BINS)
            bins = np.where(ratio > 0, np.clip(place, LOWEST * BINS, HIGHEST * BINS), LOWEST * BINS - 1).astype(np.int64)
            code, n = np.unique(bucket_of(context) << 32 | (bins + (1 << 20)), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((code >> 32).astype(np.int32)), pa.array(((code & 0xFFFFFFFF) - (1 << 20)).astype(np.int32)), pa.array(n.astype(np.int64))],
                ["bucket", "bin", "n"],
            )

    return count


def _scores(estimates: Estimates):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _answered(batches):
            starts = np.cumsum(block.sizes) - block.sizes
            summed = lambda x: np.add.reduceat(x, starts)
            base = np.log10((block.word + 1) / (estimates.n + estimates.v + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.doc_ids, pa.int64()), pa.array(block.held_out), pa.array(block.sizes), pa.array(summed((block.word > 0).astype(np.int64))),
                 pa.array(summed(base)), pa.array(summed(estimates.log10(block.pair, block.context, block.word)))],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return score


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``held_out`` is a column over doc_id; rows where it is true teach nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), whole(F.col("text").cast("string")).alias("text"))
    blocks, blocks_path = stored(rows.mapInArrow(_blocks, BLOCKS), "lm-blocks")
    totals = blocks.select(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("tokens")).agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("blocks")
    ).first()
    ranges = (totals.tokens or 0) // RANGE + 1
    asked = blocks.mapInArrow(_questions(ranges), "owner long, block string, n long, steps binary, counts binary")
    dealt = asked.repartition(ranges, "owner").sortWithinPartitions("owner", "block")
    schema = "block string, owner long, n long, counts binary, bins array<bigint>, bin_words array<bigint>, bin_tokens array<bigint>"
    answers, answers_path = stored(dealt.mapInArrow(_answers, schema), "lm-answers")

    told = answers.select(F.explode(F.arrays_zip("bins", "bin_words", "bin_tokens")).alias("b"))
    bins = told.groupBy("b.bins").agg(F.sum("b.bin_words").alias("words"), F.sum("b.bin_tokens").alias("tokens")).collect()  # 4000 at most
    words, tokens = (np.array([r[k] for r in bins], float) for k in (1, 2))
    n, v = int(tokens.sum()), int(words.sum())
    known = learn_known(n, v, tokens / np.maximum(words, 1), tokens)
    estimates = Estimates(n, v, known, np.zeros(BUCKETS))

    own = blocks.withColumn("owner", F.lit(-1).cast("long")).withColumn("counts", F.lit(None).cast("binary"))
    columns = ["block", "owner", "n", "counts", "doc_ids", "held_out", "sizes", "words", "tokens"]
    missing = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in columns[4:]]
    both = own.select(columns).unionByName(answers.select(*columns[:4], *missing))
    met = both.repartition(max(totals.blocks, 1), "block").sortWithinPartitions("block", "owner")
    counted = met.mapInArrow(_histograms(estimates), "bucket int, bin int, n long").groupBy("bucket", "bin").agg(F.sum("n").alias("n"))
    histogram = counted.collect()  # buckets times bins at most
    if histogram:
        estimates.weights = learn_weights(*(np.array([r[k] for r in histogram], np.int64) for k in range(3)))
    scored = met.mapInArrow(
        _scores(estimates), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    scored, _ = stored(scored, "lm-scores")  # a few numbers a text, so that the blocks can go
    dropped(docs.sparkSession, blocks_path, answers_path)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def every_seventh(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 7 == 2
