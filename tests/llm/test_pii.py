import hashlib
import re

import pytest

from odd_rows import ODD
from tidemark.llm.pii import digest, personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    digits = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in digits) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(number) <= 19 and luhn(number),
                "phone": 8 <= len(number) <= 15,
            }
            if ok[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    "mail jo.do+x@site-a.example.org, a@b.c_d@e.f x@y a@b@c.d @a.b a@b. é@é.e über@ü.de ßa@b.cd",
    "1.2.3.4 256.1.1.1 0001.002.3.4 1.2.3.4.5.6.7.8 1.2.3 999.1.2.3.4 1..2.3.4 12345678901.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 12  4111 1111 1111 1111, 41111111111111110000000",
    "+1 (456) 555-2186, +49 30 1234567 +1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +5 ++49 170 1234567(",
    "é" * 40 + " 10.0.0.1 \U0001F600 +49 170 1234567 \n x@y.zz\t4111111111111111",
    "+4111111111111111 4111111111111111@x.yz 1.1.1.1@1.1.1.1",
]


@pytest.fixture(scope="module")
def spans(documents):
    pairs = [*enumerate(TEXTS, 10), *ODD]
    return pairs, digest(personal_data(documents(*pairs, clash=True))).collect()


def test_base_spans_match_the_plain_patterns(spans):
    pairs, rows = spans
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted(((i, hashlib.sha256(",".join(base(t)).encode()).hexdigest()) for i, t in pairs), key=key)
    assert sorted(((r.doc_id, r.base_sha256) for r in rows), key=key) == expected
    for r in rows:
        if r.doc_id and r.doc_id >= 10:
            mine = base(TEXTS[r.doc_id - 10])
            assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x.startswith(k) for x in mine) for k in PATTERNS]
            assert [x for x in r.spans.split(",") if x.split(":")[0] in PATTERNS] == mine


def test_checksum_and_context_decide_added_spans(documents):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33"
    texts = [f"konto {good}.", f"konto {bad}.", "call 555-123-4567 now", "lot 555-123-4567 x", "tel +1 555 123 4567"]
    rows = {r.doc_id: r.spans for r in digest(personal_data(documents(*enumerate(texts)))).collect()}
    assert rows[0] == f"iban:6:{6 + len(good)}" and rows[1] == ""
    assert rows[2] == "local_phone:5:17" and rows[3] == ""
    assert rows[4].startswith("phone:") and "local" not in rows[4]


def test_long_texts_stay_linear(documents):
    texts = ["a" * 200_000, "1" * 200_000, "a." * 100_000 + "@b.c", "+1" + " " * 200_000, "1." * 100_000, "x@" + "a." * 100_000]
    rows = digest(personal_data(documents(*enumerate(texts)))).collect()
    assert len(rows) == 6 and [r.n_email for r in sorted(rows)] == [0, 0, 1, 0, 0, 1]


def test_empty_table(documents):
    assert digest(personal_data(documents())).count() == 0


def test_an_iban_ends_where_its_checksum_does(spark):
    """A word in capitals behind the number is no part of it; of several ends the longest valid one counts."""
    texts = {
        1: "account BE68 5390 0754 7034 EUR paid", 2: "account BE68 5390 0754 7034", 3: "bank DE89 3704 0044 0532 0130 00 BIC",
        4: "account BE68 5390 0754 7035 EUR", 5: "konto BE68539007547034 und BE68 5390 0754 7034 CHF",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.iban] for r in personal_data(docs).collect()}
    number = "BE68 5390 0754 7034"
    assert found == {1: [number], 2: [number], 3: ["DE89 3704 0044 0532 0130 00"], 4: [], 5: [number.replace(" ", ""), number]}
