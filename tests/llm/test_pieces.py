import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from odd_rows import ODD
from tidemark.llm.pieces import Segmenter, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  two  blanks ", "The quick brown fox, jumps!", "Zeile\n\nzwei\tund\r\ndrei", "überÄÖ ñandú ça élève",
    "日本語と한국어 \U0001F600‍ x", "a" * 300 + "the" * 200, "nul\0l", "12345 67,8.9", " " * 50 + "x" + " " * 9,
]


def cut(segmenter, texts, ids=None):
    flat, ends = segmenter.encode(ids or list(range(len(texts))), texts)
    return [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_without_dropout_it_is_the_library(prose):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + [prose(k, 200) for k in range(5)]
    assert cut(Segmenter(MODEL, 0.0, 1, 4), texts) == [library.encode(t) for t in texts]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_decoding_gives_every_text_back(rate):
    segmenter = Segmenter(MODEL, rate, 1, 4)
    texts = [*TEXTS, "literal ▁ sign▁▁ ▁", "▁"]
    assert [segmenter.decode(x) for x in cut(segmenter, texts)] == texts


def test_dropout_varies_by_document_and_repeats_by_seed(prose):
    text = prose(1, 100)
    first, again, other, seeded = (
        cut(Segmenter(MODEL, 0.2, seed, 4), [text], [i])[0] for seed, i in ((1, 5), (1, 5), (1, 6), (2, 5))
    )
    assert first == again and first != other and first != seeded
    assert len(first) > len(cut(Segmenter(MODEL, 0.0, 1, 4), [text])[0])


def test_heap_and_matrix_agree(monkeypatch, prose):
    from tidemark.llm import pieces

    text = prose(3, 300)
    matrix = cut(Segmenter(MODEL, 0.3, 9, 4), [text])
    monkeypatch.setattr(pieces, "WIDE", 8)
    assert cut(Segmenter(MODEL, 0.3, 9, 4), [text]) == matrix


def test_frame_keeps_rows_and_columns(documents):
    docs = documents(*ODD, *enumerate(TEXTS, 50), clash=True)
    out = encode_pieces(docs, MODEL, decoded=True)
    assert set(out.columns) == {*docs.columns, "lossless", "decoded"}
    rows = out.collect()
    assert len(rows) == len(ODD) + len(TEXTS) and all(r.lossless for r in rows)
    assert all(r.decoded == (r.text or "") for r in rows)
    assert encode_pieces(documents(), MODEL).count() == 0
    twice = [r.pieces for r in rows if r.text == "twice"]
    assert twice[0] == twice[1]
    only = encode_pieces(docs, MODEL, keep=["doc_id"])
    assert only.columns == ["doc_id", "pieces", "lossless"] and only.where(F.size("pieces") == 0).count() == 3


def test_every_occurrence_draws_its_own_skips():
    """A word of one possible merge is split in a tenth of its places; a longer word has many segmentations."""
    n, segmenter = 20_000, Segmenter(MODEL, 0.1, 42)
    whole, *_ = cut(Segmenter(MODEL, 0.0, 42), ["a"])
    assert len(whole) == 1
    flat, _ = segmenter.encode([1], [" ".join(["a"] * n)])
    assert 0.09 < (len(flat) - n) / n < 0.11
    assert len({tuple(x) for x in cut(segmenter, [" international"] * 2000)}) > 8


def test_an_occurrence_without_skipped_merges_equals_its_own_agenda(monkeypatch, prose):
    """Each occurrence, whether taken from the segmentation without dropout or not, gives what its agenda gives."""
    import numpy as np

    from tidemark.llm import pieces

    text, segmenter = prose(4, 400), Segmenter(MODEL, 0.1, 3)
    taken = cut(segmenter, [text], [8])
    monkeypatch.setattr(pieces.Segmenter, "skipped", lambda self, key, met, f=pieces.Segmenter.skipped: f(self, key, met) | (np.ndim(key) == 1) & (len(met) > 1000))
    assert cut(segmenter, [text], [8]) == taken


def heaps(monkeypatch, segmenter, texts):
    """The pieces of texts when every unit runs a heap of its own."""
    from tidemark.llm import pieces

    with monkeypatch.context() as patch:
        patch.setattr(pieces, "WIDE", 1)
        return cut(segmenter, texts)


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
@pytest.mark.parametrize("shared", [1, 2, 50])
def test_shared_agendas_give_what_each_occurrence_would_get(monkeypatch, prose, rate, shared):
    segmenter = Segmenter(MODEL, rate, 7, shared)
    texts = [" ".join([prose(5, 40), "the of international"] * 20), "", *TEXTS, " international" * 400, "mississippi banana"]
    assert cut(segmenter, texts) == heaps(monkeypatch, segmenter, texts)


def test_occurrences_with_the_same_skips_share_an_agenda(monkeypatch):
    """Work grows with the distinct ways a unit is cut, not with its occurrences."""
    ran, narrow = [], Segmenter.narrow
    monkeypatch.setattr(Segmenter, "narrow", lambda self, ids, *rest: ran.append(len(ids)) or narrow(self, ids, *rest))
    flat, _ = Segmenter(MODEL, 0.1, 42).encode([1], [" international" * 20_000])
    assert len(flat) > 21_000 and sum(ran) < 2_000


def test_texts_of_pieces_are_decoded_together():
    segmenter = Segmenter(MODEL, 0.3, 1)
    texts = [*TEXTS, "literal ▁ sign▁▁ ▁", "▁", ""]
    for some in (texts, [""], []):
        assert segmenter.decode_all(*segmenter.encode(list(range(len(some))), some)).to_pylist() == some
