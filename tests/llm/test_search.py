import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm import search as S
from colweave.llm.search import Params, Vocabulary, search, terms_of
from colweave.llm.text import flat, pieces, span_hash, word_spans

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(rows, items, top=10):
    bags = [(r[0], Counter(terms(r[1]))) for r in rows]
    N, L = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, bag in bags:
            n, score = sum(bag.values()), 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * n * N) // L
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item_id, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def asked(spark, items):
    return spark.createDataFrame([(*i, "a", 1) for i in items], "item_id long, text string, doc_id string, rank long")


def check(spark, rows, items, params=None):
    got = search(frame(spark, rows), asked(spark, items), params)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == brute(rows, items, (params or Params()).top)
    return found


def test_against_brute_force_with_copies_and_ties(spark):
    rng = random.Random(3)
    rows = [(k, words(rng.randint(1, 60), k, 90), "en") for k in range(300)]
    rows += [(1000 - k, rows[5][1], "en") for k in range(40)]  # copies: one class, ranked by doc_id
    rows += [(2000 + k, " ".join(sorted(rows[7][1].split(), key=lambda w: (k, hash(w)))).upper(), "en") for k in range(15)]  # one bag, other texts
    rows += [(3000 + k, f"{rows[9][1]} beyond{k} items", "en") for k in range(12)]  # other words outside the items
    items = [(k, words(12, 500 + k, 90)) for k in range(20)] + [(50, rows[5][1]), (51, rows[7][1] + " " + rows[7][1]), (52, rows[9][1])]
    assert check(spark, rows, items)
    check(spark, rows, items, Params(top=3, block_items=5, cells=50))


def test_odd_rows(spark, odd_rows):  # noqa: F811
    rows = [*odd_rows, (20, "Ärger ÄRGER ärger", "de"), (21, "a_b-c.d 12x", "en"), (22, "ONE w1 w2 w3", "en"), (22, "ONE w1 w2 w3", "en")]
    items = [(1, None), (2, ""), (3, "one"), (4, words(300, 1)), (5, "ärger"), (6, "a b c d 12x 12X"), (7, "nowhere"), (None, "two"), (8, "?!"), (9, "w1 w1 w2")]
    found = check(spark, rows, items)
    assert any(r[2] is None for r in found)


def test_empty_tables(spark):
    assert check(spark, [], [(1, "a")]) == []
    assert check(spark, [(1, "a b", "en")], []) == []
    assert check(spark, [(1, None, "en"), (2, "", None)], [(1, "a")]) == []


def test_half_of_the_rows_are_one_class(spark):
    rows = [(5000 - k, "hot words here", "en") for k in range(2000)] + [(k, words(20, k, 300), "en") for k in range(500)]
    found = check(spark, rows, [(1, "hot"), (2, "words w1"), (3, "here here w2")])
    assert [r[2] for r in sorted(found)[:10]] == list(range(3001, 3011))


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(S, "span_hash", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    text = b"ab cd ef xy cd zz abc"
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), S.TERM)
    known = [b"ab", b"cd", b"ef", b"gh"]
    place, number = Vocabulary(known).find(data, starts, ends)
    found = {int(p): known[n] for p, n in zip(place, number, strict=True)}
    assert found == {0: b"ab", 1: b"cd", 2: b"ef", 4: b"cd"}


@pytest.mark.parametrize("limit", [1, 5, 16, 64])
def test_long_texts_are_cut_between_words(limit):
    import pyarrow as pa

    text = "  one two\nthree fourfourfourfourfour five,six" + " " * 40 + "Ä" * 30 + " end"
    data, offsets = flat(pa.array([text]))
    got = []
    for part, own, first in pieces(data, offsets, S.TERM, limit):
        starts, ends, _ = word_spans(part, own, S.TERM)
        got += [bytes(part[a:b]) for a, b in zip(starts, ends, strict=True)]
        assert first == 0
    assert got == [w.encode() for w in TERM.findall(text)]
    assert terms_of(text) == [t.encode() for t in terms(text)]


def test_span_hash_is_used_for_lookup():
    data = np.frombuffer(b"one two one", np.uint8)
    h = span_hash(data, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert h[0] == h[2] != h[1]
