import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import ODD
from tidemark.llm import lm
from tidemark.llm.lm import Estimates, every_seventh, learn_known, learn_weights, score_texts, squeezed, unsqueezed, words_of


def test_words():
    assert words_of("Ab C\tÉd\x0b x\x1cy") == ["ab c".encode(), "Éd".encode(), b"x\x1cy"] and words_of(None) == []


@pytest.mark.parametrize("values", [[], [1], [2**63, 5, 0]])
def test_packed_numbers_come_back(values):
    array = np.array(values, "<u8")
    assert (unsqueezed(squeezed(array), len(array), "<u8") == array).all()


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def counts(pairs):
    words, both, tokens = Counter(), Counter(), {}
    for n, (i, t) in enumerate(pairs):
        row = [*words_of(t), b""]
        tokens[n] = row
        if not is_held(i):
            words.update(row)
            both.update(zip([b"", *row], row))
    return words, both, tokens


def brute(pairs):
    words, both, tokens = counts(pairs)
    n, v = sum(words.values()), len(words)
    loo = Counter(words.values())
    c = np.array(sorted(loo), float)
    known = learn_known(n, v, c, c * np.array([loo[int(x)] for x in c]))
    estimates = Estimates(n, v, known, np.zeros(lm.BUCKETS))
    seen = Counter()
    for (a, b), k in both.items():
        if words[a] > 1:
            ratio = (k - 1) / (words[a] - 1) / float(estimates.alone(np.array(words[b]), 1))
            where = lm.LOWEST * lm.BINS - 1 if ratio == 0 else math.floor(math.log2(ratio) * lm.BINS)
            seen[int(lm.bucket_of(np.array(words[a] - 1))), where] += k
    if seen:
        estimates.weights = learn_weights(*(np.array(x) for x in zip(*[(b, r, k) for (b, r), k in sorted(seen.items())])))
    out = []
    for k, (i, _) in enumerate(pairs):
        row = tokens[k]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in row)
        score = sum(
            float(estimates.log10(np.array(both[a, b]), np.array(words[a]), np.array(words[b]))) for a, b in zip([b"", *row], row)
        )
        out.append((i, is_held(i), len(row), sum(words[w] > 0 for w in row), n, base, score))
    return out


@pytest.mark.parametrize("block", [50, 3_000_000])
def test_matches_brute_force(monkeypatch, documents, prose, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    monkeypatch.setattr(lm, "RANGE", 40 * block)
    shared = prose(1, 40)
    pairs = [(k, shared + " " + prose(k % 9, 30)) for k in range(40)] + ODD
    rows = [tuple(r) for r in score_texts(documents(*pairs, clash=True), every_seventh(F.col("doc_id"))).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, *r[2:])
    for got, want in zip(sorted(rows, key=order), sorted(brute(pairs), key=order), strict=True):
        assert got[:5] == want[:5] and got[5:] == pytest.approx(want[5:], rel=1e-6)


def test_probabilities_of_all_words_add_up_to_one():
    words = np.array([5, 3, 1, 1])
    estimates = Estimates(10, 4, 0.8, np.linspace(0, 0.9, lm.BUCKETS))
    pairs = np.array([2, 1, 0, 0, 0])  # after a context seen three times, and one unknown word at the end
    p = 10 ** estimates.log10(pairs, np.full(5, 3), np.append(words, 0))
    assert p.sum() == pytest.approx(1)


def test_mixture_predicts_held_out_text_better(documents, prose):
    pairs = [(k, " ".join(prose(k % 7 + j, 12) for j in range(6))) for k in range(200)]
    held = [r for r in score_texts(documents(*pairs), every_seventh(F.col("doc_id"))).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(documents):
    assert score_texts(documents(), every_seventh(F.col("doc_id"))).count() == 0
    row = score_texts(documents((1, "a b")), F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_few_hashes_and_very_many_ranges(documents, prose, monkeypatch):
    """A block loops over the ranges it has hashes of, not over all of them."""
    block = next(lm._blocks([_batch([(1, False, prose(1, 20)), (2, True, "a b")])])).to_pylist()[0]
    asked = list(lm.Block(block).questions(10**7))
    assert 1 < len(asked) < 100 and all(len(h) for _, _, h, _ in asked)
    few = {(kind, int(h)): int(c) for kind, _, hashes, counts in lm.Block(block).questions(3) for h, c in zip(hashes, counts)}
    assert few == {(kind, int(h)): int(c) for kind, _, hashes, counts in asked for h, c in zip(hashes, counts)}


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["doc_id", "held_out", "text"])


def token_level(pairs):
    """The model by its formula alone: EM over single tokens taken out of all counts, no histograms, nothing shared."""
    words, both, tokens = counts(pairs)
    n, v = sum(words.values()), len(words)
    training = [(a, b) for k, (i, _) in enumerate(pairs) if not is_held(i) for a, b in zip([b"", *tokens[k]], tokens[k])]
    known = 0.9
    for _ in range(60):
        parts = [known * (words[b] - 1) / (n - 1) for _, b in training]
        known = sum(p / (p + (1 - known) / (v + 1)) for p in parts) / n
    alone = lambda w, less: known * (words[w] - less) / (n - less) + (1 - known) / (v + 1)
    bucket = lambda c: c.bit_length()
    groups = {}
    for a, b in training:
        if words[a] > 1:
            groups.setdefault(bucket(words[a] - 1), []).append(((both[a, b] - 1) / (words[a] - 1), alone(b, 1)))
    weights = {0: 0.0}
    for k, found in groups.items():
        weight = 0.5
        for _ in range(60):
            weight = sum(weight * p / (weight * p + (1 - weight) * q) for p, q in found) / len(found)
            weight = min(max(weight, 1e-6), 1 - 1e-6)
        weights[k] = weight
    for k in range(1, 60):
        weights.setdefault(k, weights[k - 1])
    score = lambda a, b: math.log10(weights[bucket(words[a])] * both[a, b] / max(words[a], 1) + (1 - weights[bucket(words[a])]) * alone(b, 0))
    return {i: sum(score(a, b) for a, b in zip([b"", *tokens[k]], tokens[k])) for k, (i, _) in enumerate(pairs)}


def test_weights_match_em_over_single_tokens(documents, prose):
    pairs = [(k, " ".join(prose(k % 7 + j, 12) + f" own{k % 11}" for j in range(6))) for k in range(120)]
    want = token_level(pairs)
    rows = score_texts(documents(*pairs), every_seventh(F.col("doc_id"))).collect()
    assert len(rows) == len(want) and all(r.score == pytest.approx(want[r.doc_id], rel=5e-3) for r in rows)
