import random

import numpy as np
import pytest
import xxhash

from odd_rows import ODD
from tidemark.llm.simhash import close_links, components, fingerprint, masks, near_duplicates, parts_of, without_near_duplicates


def plain(text, words=3):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[k : k + words]) for k in range(len(parts) - words + 1)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t", "one", "One two", "a b c", "Äpfel a b\nc d a b c d É", "x " * 500])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert fingerprint(text) == plain(text)


def test_spark_hash_agrees(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_close_pairs_share_a_key():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks())


def groups(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("direct", [4, 1024])
def test_links_span_the_groups_also_when_split(monkeypatch, direct):
    from tidemark.llm import simhash

    monkeypatch.setattr(simhash, "DIRECT", direct)
    rng = random.Random(2)
    prints = {rng.getrandbits(64)}
    while len(prints) < 150:
        prints.add(rng.choice(sorted(prints)) ^ sum(1 << b for b in rng.sample(range(20), rng.randint(1, 5))))
    links = close_links(np.array(sorted(prints), np.uint64))
    assert len(links) < len(prints)
    by_link = {p: p for p in prints}
    for _ in range(len(prints)):
        for a, b in links.tolist():
            by_link[a] = by_link[b] = min(by_link[a], by_link[b])
    assert by_link == groups(prints)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(500, 560)] + [(7, 7)]
    found, _ = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{k: 0 for k in range(1, 61)}, **{k: 500 for k in [*range(501, 560), 1000]}}


def test_groups_match_brute_force(documents, prose):
    texts = [prose(k, 300) for k in range(12)]
    pairs = list(enumerate(texts, 10))
    for k in range(4):
        words = texts[k].split()
        words[17] = "changed"
        pairs.append((100 + k, " ".join(words)))
        pairs.append((200 + k, texts[k]))
    pairs += ODD
    rows = near_duplicates(documents(*pairs, clash=True)).collect()
    assert len(rows) == len(pairs)
    root = groups({plain(t) for _, t in pairs})
    least = {}
    for i, t in pairs:
        key = root[plain(t)]
        least[key] = min(x for x in (least.get(key), i) if x is not None) if (i is not None or key in least) else None
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted([(i, f"{plain(t):016x}", least[root[plain(t)]]) for i, t in pairs], key=order)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in rows], key=order) == expected


def test_one_row_of_each_group_stays(documents, prose):
    text = prose(1, 300)
    docs = documents((5, text), (3, text), (3, text), (9, prose(2, 300)), (None, text), (7, None), (8, ""))
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9]
    assert without_near_duplicates(documents()).count() == near_duplicates(documents()).count() == 0


@pytest.mark.parametrize("words, distance", [(5, 6), (2, 1), (3, 3)])
def test_other_shingles_and_distances(documents, prose, words, distance):
    """Groups of the arguments' own shingle length and distance, against all pairs."""
    pairs = []
    for k in range(8):
        text = prose(k, 200).split()
        for j in range(4):
            changed = list(text)
            for at in range(j):
                changed[17 + 40 * at] = f"new{j}"
            pairs.append((10 * k + j, " ".join(changed)))
    print_of = {i: plain(t, words) for i, t in pairs}
    root = {i: i for i in print_of}
    for _ in root:
        for a in root:
            for b in root:
                if (print_of[a] ^ print_of[b]).bit_count() <= distance:
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(*pairs), words, distance).collect()}
    assert got == root
    kept = {r.doc_id for r in without_near_duplicates(documents(*pairs), words, distance).collect()}
    assert kept == set(root.values())


@pytest.mark.parametrize("distance", [1, 3, 6])
def test_finer_keys_keep_close_pairs_together(distance):
    rng = random.Random(distance)
    for _ in range(200):
        mask = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 60)))
        a = rng.getrandbits(64)
        free = [b for b in range(64) if not mask >> b & 1]
        b = a ^ sum(1 << x for x in rng.sample(free, min(rng.randint(0, distance), len(free))))
        finer = parts_of(mask, distance)
        assert len(finer) == distance + 1 and all(m & mask == mask for m in finer)
        assert any(a & m == b & m for m in finer)


@pytest.mark.parametrize("heavy", [3, 40])
def test_heavy_keys_are_dealt_to_finer_ones(monkeypatch, spark, heavy):
    """Fingerprints of one template agree in most bits: no key of more than ``heavy`` of them reaches a task, and no link is lost."""
    from tidemark.llm import simhash

    monkeypatch.setattr(simhash, "HEAVY", heavy)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 300:
        prints.add(rng.choice(sorted(prints)) ^ sum(1 << b for b in rng.sample(range(0, 64, 3), rng.randint(1, 4))))

    def table(p):
        return spark.createDataFrame([(simhash.signed(x),) for x in p], "print long")

    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(table(prints)).collect()]
    root = {p: p for p in prints}
    for _ in range(len(prints)):
        for a, b in found:
            root[a] = root[b] = min(root[a], root[b])
    assert root == groups(prints)
