import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm import sentencepiece as S
from colweave.llm.queries import PIECE_MODEL

if not os.path.exists(PIECE_MODEL):
    pytest.skip("the tokenizer file is not here", allow_module_level=True)
reader = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECE_MODEL)

TEXTS = [
    "", " ", "  a  b ", "a\nb\t c", "▁x ▁", "é́ ﬁ", "😀 中文字符测试", "aaaaaaaa" * 300, " " * 77, "x" * 5000, "http://www.example.com/a?b=c&d=e",
    "def f(x):\n    return x**2 + 1\n", "\x00\x01�", "Привет, как дела? こんにちは", "<s></s><unk><0x41>", "1234567890" * 9, "mississippi " * 50,
]


@pytest.fixture(scope="module")
def model():
    return S.load(PIECE_MODEL)


def encoded(model, texts):
    ids, ends = S._Encoder(model).encode(texts)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def test_the_pieces_are_those_of_merging(model):
    texts = TEXTS + [words(200, k) for k in range(5)]
    assert encoded(model, texts) == [reader.encode(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcdeionrst  .,\n▁é中😀ABT0129_-", max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    model = S.load(PIECE_MODEL) if not _held else _held[0]
    _held[:] = [model]
    assert encoded(model, texts) == [reader.encode(t) for t in texts]


_held: list = []


def test_chunks_seen_before_and_forgotten(model, monkeypatch):
    encoder = S._Encoder(model)
    texts = [words(300, k, 50) for k in range(6)]
    want = [reader.encode(t) for t in texts]
    for limit in (10**6, 20):
        monkeypatch.setattr(S, "KNOWN_CHUNKS", limit)
        for t, w in zip(texts, want, strict=True):
            assert encoder.encode([t])[0].tolist() == w


def test_round_trip_over_spark(spark, model, odd_rows):  # noqa: F811
    rows = [*odd_rows, *[(100 + k, t, None) for k, t in enumerate(TEXTS)]]
    both = S.decode(S.encode(frame(spark, rows), model), model).collect()
    assert len(both) == len(rows)
    for r in both:
        assert (r.size, r.node, r.doc) == ("x", "y", "z")
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == reader.encode(r.text) and r.decoded == reader.decode(r.ids)
            assert r.decoded == r.text.replace("▁", " ")
    assert S.decode(S.encode(frame(spark, []), model), model).collect() == []


def test_decoding_odd_numbers(spark, model):
    rows = [(1, [None, -5, 10**6]), (2, [3 + 0xFF]), (3, []), (4, None)]
    got = {r.k: r.decoded for r in S.decode(spark.createDataFrame(rows, "k int, ids array<int>"), model).collect()}
    assert got[2] == "�" and got[3] == "" and got[4] is None and "⁇" in got[1]
