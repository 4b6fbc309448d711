import re

from odd_rows import ODD
from tidemark.llm.decontaminate import contaminated, digest, without_contaminated


def words(text):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items, width=10):
    ws, hit, ids = words(text), set(), set()
    for item, body in items:
        iw = words(body)
        n = min(width, len(iw))
        for k in range(len(iw) - n + 1 if n else 0):
            for s in range(len(ws) - n + 1):
                if ws[s : s + n] == iw[k : k + n]:
                    hit |= set(range(s, s + n))
                    ids.add(str(item))
    return len(ws), len(hit), sorted(ids)


def check(spark, documents, pairs, items):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, key string")
    rows = contaminated(documents(*pairs, clash=True), benchmark).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, tuple(r["items"])) for r in rows)
    assert got == sorted((i or -1, n, h, tuple(ids)) for i, t in pairs for n, h, ids in [brute(t, items)])
    return rows


def test_matches_brute_force(spark, documents, prose):
    items = [(k, prose(100 + k, 14 + k)) for k in range(6)]
    items += [(20, "Only two"), (21, "single"), (22, "a b c d e"), (23, None), (24, "  "), (25, items[0][1]), (3, items[3][1])]
    first = items[0][1].split()
    pairs = [(k, prose(k, 60)) for k in range(10)]
    pairs += [
        (50, prose(7, 20) + " " + items[0][1].upper() + " " + prose(8, 5)),
        (51, " ".join(first[:10])),
        (52, " ".join(first[:9])),
        (53, " ".join(first[2:12]) + ", " + " ".join(first[2:12])),
        (54, "single ONLY-two single a b c d e"),
        (55, "a b c d only"),
        *ODD,
    ]
    rows = check(spark, documents, pairs, items)
    assert {r.doc_id for r in rows if r.n_hit} == {50, 51, 53, 54}


def test_overlapping_repeats_of_one_word(spark, documents):
    check(spark, documents, [(1, "ha " * 25), (2, "ha " * 9), (3, "ha ho " * 12)], [(1, "ha " * 12), (2, "ho ha " * 6)])


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = digest(contaminated(documents((1, "a b c")), none)).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows] == [(1, 3, 0, 0, False)]
    assert contaminated(documents(), none).count() == 0


def test_stage_drops_hit_rows_only(spark, documents, prose):
    item = prose(1, 12)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents((1, "before " + item), (1, "another text of the same id"), (None, item), (2, None), (3, "x"), (3, "x"))
    kept = without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, "another text of the same id"), (2, ""), (3, "x"), (3, "x")]
