import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD

from tidemark.llm import phrases as module
from tidemark.llm.phrases import Trie, Tries, bit_set, collocations, pieces, shard_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least, top):
    """Straight from the definition, by counters."""
    out = []
    by_lang = {}
    for lang, text in rows:
        by_lang.setdefault(lang or "und", []).extend(cut(text))
    for lang, found in by_lang.items():
        f = Counter(tuple(p[i : i + k]) for p in found for k in (1, 2, 3) for i in range(len(p) - k + 1))
        n = sum(map(len, found))
        candidates = {c: a for c, a in f.items() if len(c) > 1 and a >= least}
        scored = []
        for c, a in candidates.items():
            if any(c in (x[:2], x[1:]) and 100 * b >= 50 * a for x, b in candidates.items() if len(x) > len(c)):
                continue
            score, k = min((10**6 * a * a // (f[c[:k]] * f[c[k:]]), k) for k in range(1, len(c)))
            scored.append((-score, -a, " ".join(c).encode(), f[c[:k]], f[c[k:]]))
        out += [(lang, r, p.decode(), -a, l, q, n, -s) for r, (s, a, p, l, q) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def speech(rng, n):
    """Sentences with set phrases, frequent words and rare ones."""
    words = []
    for _ in range(n):
        words += rng.choice([["new", "york", "City"], ["New", "york"], ["of", "the"], ["é", "à"], ["a", "a", "a", "a"], [f"w{rng.randint(0, 400)}"], [f"w{rng.randint(0, 9)}"]])
        words.append(rng.choice(["", "", "", ".", "\n", "\t", ", "]))
    return " ".join(words)


def table(spark, rows):
    return spark.createDataFrame([(k, t, lang, "x", 7) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int")


def found(df):
    return sorted(map(tuple, df.collect()))


def test_pieces():
    text = "Ab  c\td.E,,f\x0b\x1cg\r\nh i j"
    got = [[]]
    for w in pieces(text.encode()):
        got.append([]) if w == b"\n" else got[-1].append(w.decode()) if w else None
    assert [p for p in got if p] == [p for p in cut(text) if p]


@pytest.mark.parametrize("length", [1, 2, 3])
def test_a_trie_accepts_its_phrases_alone(length):
    rng = np.random.default_rng(length)
    alphabet = rng.integers(1, 2**63, 60).astype(np.uint64)
    texts = rng.integers(0, 60, 4000)
    hashes = np.concatenate([np.zeros(1, np.uint64), alphabet])
    tokens = np.concatenate([np.where(rng.random(4000) < 0.1, 0, texts + 1), np.zeros(3, np.int64)])
    windows = np.lib.stride_tricks.sliding_window_view(tokens, length)
    whole = {tuple(w) for w in windows.tolist() if 0 not in w}
    chosen = sorted(whole)[:: 2 if length < 3 else 5]
    trie, states = Trie.built(hashes[np.array(chosen)])
    assert len(set(states.tolist())) == len(chosen)
    again = Trie.unpacked(*trie.packed())
    places, accepted = again.advanced(tokens, hashes, length)
    name = dict(zip(states.tolist(), chosen))
    want = [(p, tuple(w)) for p, w in enumerate(windows.tolist()) if tuple(w) in set(chosen)]
    assert [(p, name[s]) for p, s in zip(places.tolist(), accepted.tolist())] == want
    assert len(trie.base) < 40 * len(chosen)


def test_a_trie_of_many_phrases_stays_small():
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(1, 2**63, 20_000).astype(np.uint64))
    rank = np.minimum(rng.zipf(1.3, (150_000, 2)) - 1, len(words) - 1)
    phrases = np.unique(words[rank], axis=0)
    trie, states = Trie.built(phrases)
    assert len(set(states.tolist())) == len(phrases) and len(trie.base) < 4 * (len(phrases) + len(words))
    tokens = np.concatenate([np.searchsorted(trie.words, phrases).ravel() + 1, np.zeros(3, np.int64)])
    places, accepted = trie.advanced(tokens, np.concatenate([np.zeros(1, np.uint64), trie.words]), 2)
    assert (accepted[np.isin(places, np.arange(0, 2 * len(phrases), 2))] == states).all()


@pytest.mark.parametrize("length", [1, 2, 3])
def test_tries_of_many_shards_find_what_one_trie_finds(monkeypatch, spark, length):
    """Every place is followed in the trie of its own shard alone, also where stretches of a block meet."""
    monkeypatch.setattr(module, "STRETCH", 700)
    rng = np.random.default_rng(length)
    alphabet = rng.integers(1, 2**64, 90, np.uint64)
    hashes = np.concatenate([np.zeros(1, np.uint64), alphabet])
    tokens = np.concatenate([np.where(rng.random(5000) < 0.1, 0, rng.integers(1, 61, 5000)), np.zeros(3, np.int64)])
    windows = np.lib.stride_tricks.sliding_window_view(tokens, length)
    whole = sorted({tuple(w) for w in windows.tolist() if 0 not in w})[:: 2 if length < 3 else 5]
    phrases = hashes[np.array(whole + [(k + 60,) * length for k in range(1, 31)])]
    h = module.names(length)
    rows = spark.createDataFrame(phrases.view(np.int64).tolist(), ", ".join(f"{c} long" for c in h))
    of = np.array([r[0] for r in rows.select(shard_of(h, 7)).collect()])
    one, states = Trie.built(phrases)
    want = sorted(zip(*[x.tolist() for x in one.advanced(tokens, hashes, length)]))
    name, got = {}, []
    for group in ([0, 1, 2, 3], [4, 5, 6]):
        built = {k: Trie.built(phrases[of == k]) for k in group if (of == k).any()}
        tries = Tries(7, {k: Trie.unpacked(*trie.packed()) for k, (trie, _) in built.items()})
        for k, root in zip(tries.those, tries.roots):
            name |= dict(zip(((group[0], s) for s in (built[k][1] + root).tolist()), states[of == k].tolist()))
        found = [np.concatenate(part) for part in zip(*tries.advanced(tokens, hashes, length))]
        assert (np.diff(found[0]) > 0).all()
        got += [(p, name[group[0], s]) for p, s in zip(*[x.tolist() for x in found])]
    assert len(set(of.tolist())) == 7 and sorted(got) == want and len(want) > 500


def test_a_pass_over_the_blocks_serves_many_shards(monkeypatch, spark):
    """More candidates mean more shards, but not as many passes."""
    labels, put = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, label: (labels.append(label), put(df, label))[1])
    monkeypatch.setattr(module, "ENTRIES", 20)
    monkeypatch.setattr(module, "SLICE", 64)
    rng = random.Random(8)
    rows = [("en", " ".join(f"w{rng.randint(0, 11)}" for _ in range(2500))) for _ in range(2)]
    got = found(collocations(table(spark, rows), least=10, top=500))
    assert got == brute(rows, 10, 500) and len(got) > 140
    assert labels.count("trie-counts") == 3  # 144 pairs in 8 shards take two passes, few triples one; before, one a shard


@pytest.mark.parametrize("block, entries", [(60, 500_000), (1_000_000, 20)])
def test_matches_brute_force(monkeypatch, spark, block, entries):
    """Blocks of a few texts, and tries of a few phrases."""
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "ENTRIES", entries)
    rng = random.Random(3)
    rows = [(lang, speech(rng, rng.randint(0, 60))) for lang in ("en", "de", None, "en") for _ in range(40)]
    rows += [("en", t) for _, t in ODD] + [("copy", "Same text here.") for _ in range(30)]
    got = found(collocations(table(spark, rows), least=10, top=40))
    assert got == brute(rows, 10, 40)
    assert {r[0] for r in got} == {"en", "de", "und", "copy"} and any(len(r[2].split()) == 3 for r in got)


def test_counts_beyond_64_bits_stay_exact(spark):
    from pyspark.sql import functions as F

    a, l, r = 3_000_000_000_000, 4_000_000_000_001, 5_000_000_000_003
    got = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(module._ratio(F.col("l"), F.col("r"))).first()[0]
    assert got == 10**6 * a * a // (l * r)


def test_bit_set_holds_the_upper_bits(spark):
    hashes = [0, 1, -1, 2**63 - 1, -(2**63), 5 << 38, 123456789 << 30]
    bits = np.frombuffer(bit_set(spark.createDataFrame([(h,) for h in hashes], "hash long")), np.uint8)
    want = {(h & (2**64 - 1)) >> (64 - module.BITS) for h in hashes}
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == want


def test_no_phrases(spark):
    assert found(collocations(table(spark, []))) == []
    assert found(collocations(table(spark, [("en", None), (None, ""), ("en", " . ,")]))) == []
    assert found(collocations(table(spark, [("en", "seldom words")] * 9))) == []


def test_a_long_text_is_followed_whole(spark):
    text = "alpha beta gamma " * 120_000 + "tail end"
    got = found(collocations(table(spark, [("en", text)])))
    assert got == brute([("en", text)], 10, 2000) and got[0][3] == 120_000
