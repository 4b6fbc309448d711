import math
import re
from collections import Counter

import pytest
from odd_rows import ODD

from tidemark.llm import ranked as module
from tidemark.llm.ranked import asked_terms, ranked, terms_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, c in counted:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def benchmark(spark, *pairs, kind="long"):
    return spark.createDataFrame([(i, t, "x") for i, t in pairs], f"item_id {kind}, text string, score string")


def test_terms():
    assert terms_of("Ab-c É_é 1٢@x\tZ".encode()) == [w.encode() for w in words("Ab-c É_é 1٢@x\tZ")]
    assert terms_of("a\x1cb\x85c d".encode()) == [w.encode() for w in words("a\x1cb\x85c d")]


@pytest.mark.parametrize("docs_per_block, items_per_bundle, bound", [(7, 3, 500_000), (8192, 256, 500_000), (16, 2, 0)])
def test_matches_brute_force(monkeypatch, spark, documents, prose, docs_per_block, items_per_bundle, bound):
    """Small blocks and bundles, one of each, and the joins by shuffle beyond the bound."""
    monkeypatch.setattr(module, "DOCS", docs_per_block)
    monkeypatch.setattr(module, "ITEMS", items_per_bundle)
    monkeypatch.setattr(module, "BROADCAST_TERMS", bound)
    docs = [(k, "the " * (k % 5) + prose(k % 25, 10 + k % 30)) for k in range(90)] + ODD  # copies, so ties
    items = [(k, "The " + prose(k, 6) + " nowhere") for k in range(8)] + [(3, prose(11, 4)), (50, None), (51, "- ."), (None, "one text")]
    got = found(ranked(documents(*docs, clash=True), benchmark(spark, *items), k=12))
    assert got == brute(docs, items, 12) and len(got) > 50


def test_tied_scores_go_to_the_smaller_id(spark, documents):
    docs = documents(*[(k, "same words") for k in (9, 2, 5, None, 7)], (1, "other"), (3, None))
    rows = ranked(docs, benchmark(spark, (1, "same")), k=4).orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in rows] == [(1, 2), (2, 5), (3, 7), (4, 9)]


def test_a_term_that_all_hold_adds_nothing_below_zero(spark, documents):
    docs = documents(*[(k, "all") for k in range(3000)])
    assert ranked(docs, benchmark(spark, (1, "all"))).count() == 0


def test_long_text_counts_whole(spark, documents):
    docs = documents((1, "filler " * 300_000 + "needle"), (2, "needle filler"), (3, "x"))
    rows = ranked(docs, benchmark(spark, ("q", "NEEDLE"), kind="string")).orderBy("rank").collect()
    assert [(r.item_id, r.doc_id) for r in rows] == [("q", 2), ("q", 1)]


def test_empty_tables(spark, documents):
    none, some = benchmark(spark), benchmark(spark, (1, "a"))
    assert ranked(documents(), some).count() == ranked(documents((1, "a")), none).count() == ranked(documents((1, None)), some).count() == 0
    assert asked_terms(none).count() == 0


def test_no_cross_join_and_bundles_meet_lists_by_cogroup(monkeypatch, spark, documents):
    plans = []
    keep = module.stored

    def seen(df, label):
        plans.append((label, df._jdf.queryExecution().toString()))
        return keep(df, label)

    monkeypatch.setattr(module, "stored", seen)
    ranked(documents((1, "a b"), (2, "b")), benchmark(spark, (1, "a b"))).collect()
    plan = dict(plans)["best"]
    assert plan.count("FlatMapCoGroupsInArrow") >= module.OWNERS
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
