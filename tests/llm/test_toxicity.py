import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm import toxicity as T
from colweave.llm.text import flat
from colweave.llm.toxicity import Evidence, Params, Words, score

SMALL = Params(sample_rows=2000, learners=2, rounds=3)
ROOTS = ["grubo", "skarn", "vlim"]
ENDS = ["a", "enta", "it", "orus", "eli", "um"]


def held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 3 == 1


def planted(n, share=0.2):
    """(documents, labels): the toxic ones hold a few words of some roots, anywhere."""
    rng, rows, labels = random.Random(1), [], []
    for k in range(n):
        text = words(rng.randint(20, 160), k, 600).split()
        toxic = rng.random() < share
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(ROOTS) + rng.choice(ENDS))
        rows.append((k, " ".join(text), "en"))
        labels.append((k, int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, toxic int, text string")


def test_held_out_documents_are_told_apart(spark):
    rows, labels = planted(1500)
    got = score(frame(spark, rows), label_frame(spark, labels), SMALL).collect()
    assert len(got) == len(rows) and all(r.held_out == held_out(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    toxic = dict(labels)
    held = [r for r in got if r.held_out]
    bad, good = [r for r in held if toxic[r.doc_id]], [r for r in held if not toxic[r.doc_id]]
    assert sum(r.predicted for r in bad) >= 0.95 * len(bad) and sum(r.predicted for r in good) <= 0.02 * len(good)


def test_only_labels_of_the_other_rows_count(spark):
    rows, labels = planted(400)
    turned = [(i, 1 - t if held_out(i) else t) for i, t in labels]
    both = [sorted(score(frame(spark, rows), label_frame(spark, x), SMALL).collect()) for x in (labels, turned)]
    assert both[0] == both[1]


def test_odd_rows(spark, odd_rows):  # noqa: F811
    rows, labels = planted(300)
    rows = [*[(1000 + (i or 0) if i else None, t, x) for i, t, x in odd_rows], *rows, (2000, "?! .", "en"), (2001, "x" * 500_000, "en")]
    labels += [(None, 1), (3, None), (4, 7), (5, 0), (5, 1), (1003, 1), (1004, 0)]
    got = score(frame(spark, rows), label_frame(spark, labels), SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (1001, 1002, 1003, 2000):
            assert (r.score, r.predicted) == (0.0, 0)
        if r.doc_id is None:
            assert r.held_out


def test_no_labels_one_kind_and_empty_tables(spark):
    rows, labels = planted(40)
    for some in ([], [(i, 0) for i, _ in labels], [(i, 1) for i, _ in labels]):
        got = score(frame(spark, rows), label_frame(spark, some), SMALL).collect()
        assert len(got) == len(rows) and all((r.score, r.predicted) == (0.0, 0) for r in got)
    assert score(frame(spark, []), label_frame(spark, labels), SMALL).collect() == []


@pytest.fixture()
def some():
    p = Params(window=6, stride=4, word_bits=8, char_bits=8, vector_bits=6, depth=3, hidden=4, word_bytes=10)
    texts = ["one two three four five six seven eight nine ten eleven", "a", None, "Über UND unter " * 4, "z" * 35, "- ! -"]
    rng = np.random.default_rng(2)
    evidence = Evidence(rng.standard_normal(256).astype(np.float32), rng.standard_normal(256).astype(np.float32))
    w = {k: v.astype(np.float64) for k, v in T.first_weights(p).items()}
    return p, texts, evidence, w


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_logit(x, w):
    """One window, word by word, by the equations."""
    states = []
    for way in "fb":
        h, out = np.zeros(len(w["new_f"])), [None] * len(x)
        n = len(h)
        for t in range(len(x)) if way == "f" else reversed(range(len(x))):
            a = x[t] @ w[f"in_{way}"] + w[f"in0_{way}"]
            g = h @ w[f"gate_{way}"]
            z, r = sigmoid(a[:n] + g[:n]), sigmoid(a[n : 2 * n] + g[n:])
            c = np.tanh(a[2 * n :] + (r * h) @ w[f"new_{way}"])
            h = out[t] = (1 - z) * h + z * c
        states.append(out)
    s = [np.concatenate(pair) for pair in zip(*states, strict=True)]
    score = np.array([np.tanh(v @ w["look"] + w["look0"]) @ w["pick"] for v in s])
    alpha = np.exp(score - score.max())
    alpha /= alpha.sum()
    return sum(a * v for a, v in zip(alpha, s, strict=True)) @ w["out"] + w["out0"][0]


def test_windows_and_logits_against_plain_loops(some):
    p, texts, evidence, w = some
    found = Words(*flat(pa.array(texts)), p)
    logit, start, text = T._logits(found, evidence, w, p, chunk=2)
    inputs = T._inputs(found, evidence, w, p)
    want = []
    for i in range(len(texts)):
        a, b, at = found.first[i], found.first[i + 1], 0
        while a < b:
            own = found.word[a + at : min(b, a + at + p.window)]
            want.append((i, a + at, plain_logit(inputs[own], w)))
            if a + at + p.window >= b:
                break
            at += p.stride
    assert [(i, s) for i, s, _ in want] == list(zip(text, start, strict=True))
    assert np.allclose([x for *_, x in want], logit, atol=1e-5)
    assert [int(n) for n in np.diff(found.first)] == [11, 1, 0, 12, 4, 0]  # a long word counts as several


def test_character_runs_of_every_word(some):
    p, texts, *_ = some
    found = Words(*flat(pa.array(["cab cabs b"])), p)
    alone = [Words(*flat(pa.array([x])), p) for x in ("cab", "cabs", "b")]
    by = {int(n): set(found.runs[found.cut[i] : found.cut[i + 1]]) for i, n in enumerate(found.names)}
    for x, size in zip(alone, (3 + 2 + 1, 4 + 3 + 2, 1), strict=True):
        assert by[int(x.names[0])] == set(x.runs) and len(x.runs) == size


def test_gradients_against_differences(some):
    p, texts, evidence, w = some
    found = Words(*flat(pa.array(texts)), p)
    _, start, text = T._logits(found, evidence, w, p)
    place = start[:, None] + np.arange(p.window)
    real = place < found.first[1:][text][:, None]
    x = T._inputs(found, evidence, w, p).astype(np.float64)[found.word[np.where(real, place, start[:, None])]]
    goal = np.arange(len(start)) % 2

    def loss(w, x):
        z = T.forward({way: x @ w[f"in_{way}"] + w[f"in0_{way}"] for way in "fb"}, real, w)
        return float(np.logaddexp(0, z).sum() - (goal * z).sum())

    kept = {}
    z = T.forward({way: x @ w[f"in_{way}"] + w[f"in0_{way}"] for way in "fb"}, real, w, kept)
    g, d_x = T.backward(x, real, w, kept, sigmoid(z) - goal)
    rng, e = np.random.default_rng(3), 1e-2
    for k, own in [*g.items(), ("x", d_x)]:
        at = tuple(rng.integers(0, s) for s in own.shape)
        at = (0, 1, 2) if k == "x" else at
        ends = []
        for sign in (1, -1):
            moved, seen = {n: v.copy() for n, v in w.items()}, x.copy()
            (seen if k == "x" else moved[k])[at] += sign * e
            ends.append(loss(moved, seen))
        assert abs((ends[0] - ends[1]) / (2 * e) - own[at]) < 2e-3 + 0.02 * abs(own[at]), k


def test_long_texts_are_read_whole(some, monkeypatch):
    p, _, evidence, w = some
    monkeypatch.setattr(T, "SLICE_BYTES", 6000)
    text = words(5000, 9)
    data, offsets = flat(pa.array([text]))
    parts = [bytes(d).decode() for d, _ in T._spread(data, offsets)]
    assert len(parts) > 5 and max(map(len, parts)) <= 6000
    end = 0
    for part in parts:  # every part starts well before the end of the one before it, and both ends are between words
        at = text.find(part)
        assert at == 0 or (at < end - 3000 and text[at] == " ")
        end = at + len(part)
        assert end == len(text) or text[end] == " "
    assert end == len(text)
    assert [bytes(d) for d, _ in T._spread(*flat(pa.array(["x" * 20_000])))] == [b"x" * 6000] * 3 + [b"x" * 2000]
