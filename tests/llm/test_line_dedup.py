import random

import pytest
import xxhash
from odd_rows import ODD
from tidemark.llm.line_dedup import BASE, EDGE, LONG, MODULUS, chunks, without_repeats


def texts(df):
    return {r.doc_id: (r.text, r[-1]) for r in df.collect()}


def test_a_long_passage_goes_everywhere_but_at_its_first_place(documents, prose):
    passage = prose(1, 60)
    docs = documents(
        (1, prose(2, 30) + "\n" + passage + "\n" + prose(3, 30)),
        (2, passage),
        (3, "short\n" + passage + "\nshort too\n" + passage),
        (4, prose(4, 55)),
        clash=True,
    )
    found = without_repeats(docs)
    assert found.columns == [*docs.columns, "_removed_"]
    got = texts(found)
    assert got[1][1] == 0 and passage in got[1][0]
    assert got[2] == ("", 1)
    assert got[3] == ("short\nshort too", 2)
    assert got[4] == (prose(4, 55), 0)


def test_short_common_lines_stay(documents):
    pairs = [(k, "Common line here.\nAnother one.\n" + f"own {k}") for k in range(20)]
    assert texts(without_repeats(documents(*pairs))) == {k: (t, 0) for k, t in pairs}


def named(docs):
    return docs.selectExpr("doc_id AS _id", "text AS _text")


def test_boundaries_resist_a_shift(documents, prose):
    """Many short lines behind different beginnings share all chunks but those at the beginning."""
    lines = [prose(k, 8) for k in range(200)]
    own = [prose(999, 5), prose(998, 7)]
    rows = chunks(named(documents((1, "\n".join(lines)), (2, "\n".join([*own, *lines]))))).collect()
    cut = {i: {r["_at"] - 2 * (i == 2): r["_hash"] for r in rows if r["_id"] == i} for i in (1, 2)}
    assert 40 < len(cut[1]) < 140 and all(r["_n"] == 3 for r in rows)
    assert {at for at in cut[1].keys() ^ cut[2].keys()} <= {-2, -1, 0, 1, 2}
    got = texts(without_repeats(documents((1, "\n".join(lines)), (2, "\n".join([*own, *lines])))))
    assert got == {1: ("\n".join(lines), 0), 2: ("\n".join(own), 200)}


def brute(pairs):
    """Removed lines by the method, straight from its description, for texts of plain words without blank lines."""
    docs = {}
    for i, t in pairs:
        docs[i, _signed(xxhash.xxh64_intdigest(t.encode(), 42))] = t.split("\n")
    first, places = {}, []
    for (i, key), lines in docs.items():
        words = [len(line.split()) for line in lines]
        sizes = []
        for at in range(len(lines)):
            n = next((n for n in range(1, len(lines) - at + 1) if sum(words[at : at + n]) >= LONG), None)
            sizes.append(n)
        hashes = [_signed(xxhash.xxh64_intdigest(line.encode(), 42)) % MODULUS for line in lines]
        rolled = [None if n is None else _rolled(hashes[at : at + n]) for at, n in enumerate(sizes)]
        begins = set()
        for at, n in enumerate(sizes):
            if n is not None:
                inside = [(rolled[k], k) for k in range(at, at + n) if rolled[k] is not None]
                begins.add(min(inside)[1])
        for at in sorted(begins):
            body = tuple(lines[at : at + sizes[at]])
            places.append((i, key, at, body))
            first[body] = min(first.get(body, (i, key, at)), (i, key, at))
    later = [p for p in places if first[p[3]] != p[:3] and (first[p[3]][:2] != p[:2] or p[2] >= first[p[3]][2] + len(p[3]))]
    gone = {}
    for i, key, at, body in later:
        n = len(body)
        gone.setdefault(i, set()).update(range(at, at + n))
        # Every place further on that an earlier place with the same chunk holds the same way.
        for side in (1, -1):
            for depth in range(1, EDGE + 1):
                mine = _around(docs, (i, key, at), n, side, depth)
                if mine is None:
                    break
                if _around(docs, first[body], n, side, depth) != mine:
                    like = [p[:3] for p in later if p[3] == body and _around(docs, p[:3], n, side, depth) == mine]
                    if min(like) == (i, key, at) or (min(like)[:2] == (i, key) and at < min(like)[2] + n + depth):
                        continue
                gone[i].add(at + n + depth - 1 if side > 0 else at - depth)
    return gone


def _around(docs, place, n, side, depth):
    """The lines up to ``depth`` on one side of a chunk; None beyond the text or the reach of a chunk."""
    i, key, at = place
    lines = docs[i, key]
    part = lines[at + n : at + n + depth] if side > 0 else lines[max(at - depth, 0) : at][::-1]
    if len(part) < depth or sum(min(len(x.split()), LONG) for x in part[:-1]) >= EDGE:
        return None
    return part


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def _rolled(hashes):
    total = 0
    for h in hashes:
        total = (total * BASE + h) % MODULUS
    return total


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force_on_random_lines(documents, prose, seed):
    """Texts dealt from a few passages, common lines and lines of their own, of many lengths."""
    rng = random.Random(seed)
    passages = [[prose(100 * seed + 10 * p + k, rng.randint(1, 25)) for k in range(rng.randint(2, 9))] for p in range(5)]
    common = [prose(5000 + k, rng.randint(1, 15)) for k in range(3)]
    pairs = []
    for i in range(40):
        lines = []
        for part in range(rng.randint(1, 5)):
            what = rng.random()
            passage = rng.choice(passages)
            lines += passage if what < 0.4 else passage[1:] if what < 0.5 else [rng.choice(common)] if what < 0.6 else [prose(rng.random(), rng.randint(1, 30))]
        pairs.append((i, "\n".join(lines)))
    gone = brute(pairs)
    assert len(gone) > 5
    want = {i: ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())), len(gone.get(i, ()))) for i, t in pairs}
    assert texts(without_repeats(documents(*pairs))) == want


@pytest.mark.parametrize("seed", range(3))
def test_every_repeated_run_of_fifty_words_goes(documents, prose, seed):
    """One passage of lines of any length between lines of others: all of it goes, and nothing else."""
    rng = random.Random(seed)
    pairs, want = [], {}
    for p in range(12):
        passage, k = [], 0
        while sum(len(x.split()) for x in passage) <= 50:
            passage.append(prose(f"{seed} {p} {k}", rng.choice([1, 2, 5, 9, 12, 17, 19, 26, 60])))
            k += 1
        for j in range(3):
            i, own = 100 * p + j, [[prose(f"{seed} {p} {j} {side} {n}", rng.choice([1, 6, 13, 30])) for n in range(3)] for side in (0, 1)]
            pairs.append((i, "\n".join([*own[0], *passage, *own[1]])))
            want[i] = (pairs[-1][1], 0) if j == 0 else ("\n".join([*own[0], *own[1]]), len(passage))
    assert texts(without_repeats(documents(*pairs))) == want


def test_the_smallest_run_is_the_callers_choice(documents, prose):
    """Four lines of 14 words together in many documents go when asked for."""
    block = "\n".join(prose(k, n) for k, n in enumerate((4, 3, 4, 3)))
    pairs = [(i, f"{prose(100 + i, 9)}\n{block}\n{prose(200 + i, 9)}") for i in range(30)]
    assert all(n == 0 for _, n in texts(without_repeats(documents(*pairs))).values())
    got = texts(without_repeats(documents(*pairs), long=7))
    assert got[0][1] == 0 and all(got[i] == (f"{prose(100 + i, 9)}\n{prose(200 + i, 9)}", 4) for i in range(1, 30))


def test_a_very_long_text_is_looked_through_whole(documents, prose):
    passage = [prose(k, 11) for k in range(6)]
    lines = [prose(1000 + k % 4000, 4) + f" {k}" for k in range(20_000)]
    got = texts(without_repeats(documents((1, "\n".join([*lines[:15_000], *passage, *lines[15_000:]])), (2, "\n".join(passage)))))
    assert got[2] == ("", 6) and got[1][1] == 0


def test_odd_rows_stay_as_they_are(documents, prose):
    long = prose(5, 40)
    docs = documents(*ODD, (7, long), (7, long), (8, long + "\n"), (9, "\n\n\n"))
    got = sorted((r.doc_id or 0, r.text or "", r.text is None) for r in without_repeats(docs).collect())
    expected = [(i or 0, t or "", t is None) for i, t in ODD] + [(7, long, False)] * 2 + [(8, "", False), (9, "\n\n\n", False)]
    assert got == sorted(expected)
    assert without_repeats(documents()).count() == 0


def test_a_null_id_comes_first(documents, prose):
    got = texts(without_repeats(documents((1, prose(6, 30)), (None, prose(6, 30)))))
    assert got[None][1] == 0 and got[1] == ("", 1)


def short_lines(prose, seed, lines, words):
    return "\n".join(prose(seed * 1000 + k, words) for k in range(lines))


def test_passages_of_short_lines_go_as_a_whole(documents, prose):
    """Passages of over 50 words, 4 to 12 words a line, between short and long neighbours."""
    pairs, expected = [], {}
    for words, lines in [(4, 13), (5, 11), (6, 9), (7, 8), (8, 7), (10, 6), (12, 5)]:
        for near in (3, 8, 25):
            passage, i = short_lines(prose, words, lines, words) + f"\nend {near}", 100 * words + near
            own = [short_lines(prose, 10 * i + k, 4, near) for k in range(4)]
            pairs += [(i, f"{own[0]}\n{passage}\n{own[1]}"), (10_000 + i, f"{own[2]}\n{passage}\n{own[3]}")]
            # The last line differs by neighbour, so of the later passages only the last line is new to the others.
            first = near == 3
            kept = passage if first else f"end {near}"
            expected[i] = f"{own[0]}\n{kept}\n{own[1]}"
            expected[10_000 + i] = f"{own[2]}\n{own[3]}"
    got = texts(without_repeats(documents(*pairs)))
    assert {i: t for i, (t, _) in got.items()} == expected


def test_a_text_that_repeats_a_line_keeps_one_window_of_it(documents, prose):
    line = prose(1, 8)
    assert texts(without_repeats(documents((1, "\n".join([line] * 9)))))[1] == ("\n".join([line] * 3), 6)


def test_blank_lines_go_with_the_line_above(documents, prose):
    passage = short_lines(prose, 7, 8, 7).replace("\n", "\n\n", 3)
    got = texts(without_repeats(documents((1, f"\n \na\n\n{passage}\n\nb\n"), (2, f"\nc\n\n{passage}\n\n\nd\n"))))
    assert got == {1: (f"\n \na\n\n{passage}\n\nb\n", 0), 2: ("\nc\n\nd\n", 8)}


def test_words_need_no_plain_blanks(documents, prose):
    tabbed, hard = prose(1, 30).replace(" ", "\t"), prose(2, 30).replace(" ", chr(0xA0))
    han = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(60))
    short = [prose(3, 15).replace(" ", "\t"), han[:30], "https://example.org/" + "a" * 200]
    text = "\n".join([tabbed, hard, han])
    got = texts(without_repeats(documents((1, text), (2, f"b\n{text}\nc"), *[(10 * k + j, f"{k} {j}\n{s}") for k, s in enumerate(short, 1) for j in (1, 2)])))
    assert got[1] == (text, 0) and got[2] == ("b\nc", 3)
    assert all(removed == 0 for i, (_, removed) in got.items() if i > 2)
