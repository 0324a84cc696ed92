import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm import quality as Q

SCHEMA = "doc_id long, quality int, toxic int"


def brute_model(texts, order):
    """Interpolated modified Kneser-Ney by its formulas, with plain dictionaries."""
    counts = {order: Counter()}
    for t in texts:
        marked = Q.START * (order - 1) + t if t else ""
        for i in range(len(marked) - order + 1):
            counts[order][marked[i : i + order]] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    rules = {}
    for k, own in counts.items():
        n = [sum(c == i for c in own.values()) for i in (1, 2, 3, 4)]
        share = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        rules[k] = [min(max((i + 1) - (i + 2) * share * n[i + 1] / n[i] if n[i] else 0.5 * (i + 1), 0.1), i + 0.9) for i in range(3)]

    def cut(k, c):
        return rules[k][min(c, 3) - 1]

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / (len(counts[1]) + 1)
        context = {g: c for g, c in counts[k].items() if g[:-1] == gram[:-1]}
        total = sum(context.values())
        if not total:
            return p(gram[1:])
        c = context.get(gram, 0)
        return (c - cut(k, c) if c else 0) / total + sum(cut(k, x) for x in context.values()) / total * p(gram[1:])

    return p


def test_probabilities_against_the_formulas(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcd ") for _ in range(80)) for _ in range(6)]
    p = brute_model(texts, 3)
    seen = ["abc", "a a", "dda", "zab", "abz", "zzz", "\x02\x02a", "\x02zz"]
    model = Q.train(spark.createDataFrame([(t,) for t in texts], "text string"), 3)
    got = {r.gram: r.p for r in Q.probabilities(spark.createDataFrame([(g,) for g in seen], "gram string"), model, 3).collect()}
    assert set(got) == set(seen)
    for g in seen:
        assert got[g] == pytest.approx(p(g), rel=1e-9), g


def test_the_next_characters_share_one(spark):
    texts = ["banana bandana", "ananas", "band"]
    model = Q.train(spark.createDataFrame([(t,) for t in texts], "text string"), 3)
    letters = sorted(set("".join(texts))) + ["?"]
    grams = spark.createDataFrame([(c + x,) for c in ("an", "na", "xy") for x in letters], "gram string")
    rows = Q.probabilities(grams, model, 3).collect()
    for c in ("an", "na", "xy"):
        assert sum(r.p for r in rows if r.gram[:2] == c) == pytest.approx(1)


def table(spark):
    def word(rng):
        return rng.choice(["lorem", "ipsum", "dolor", "amet", "sit", "elit", "magna", "ut", "sed", "tempor"])

    rows = []
    for k in range(400):
        rng = random.Random(k)
        rows.append((k, " ".join(word(rng) for _ in range(60)), "la" if k % 2 else "lb"))
    rows += [(1000 + k, "".join(random.Random(k).choice("qxz#$%&*!?") for _ in range(300)), "la") for k in range(20)]
    rows += [(2000 + k, " ".join(w + "!!" for w in rows[k][1].upper().split()), None) for k in range(5)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(400)] + [(1000, 0, 0), (1001, 1, 1), (3, 1, None), (None, 1, 0)], SCHEMA)
    return rows, labels


@pytest.mark.parametrize("shard_rows", [10**6, 40])
def test_junk_goes_and_clean_text_stays(spark, shard_rows):
    rows, labels = table(spark)
    got = {r.doc_id: r for r in Q.assess(frame(spark, rows), labels, Q.Params(shard_rows=shard_rows)).collect()}
    assert len(got) == len(rows)
    assert not any(got[k].accepted for k in got if k >= 1000)
    # A limit drawn from 40 held-out texts of a language is passed by 1 in 41 of the others: 8 of 320, give or take 4.
    assert sum(got[k].accepted for k in range(400)) >= 380
    assert len({r.perplexity_limit for r in got.values() if r.lang}) == 2 and got[2000].perplexity_limit
    assert all(r.size == "x" for r in got.values())


def test_perplexity_is_that_of_the_model(spark):
    rows, labels = table(spark)
    trained = [r.text for r in frame(spark, rows).where("doc_id < 400").where("pmod(xxhash64(doc_id, 5), 5) != 0").collect()]
    p = brute_model(trained, 3)
    got = {r.doc_id: r for r in Q.assess(frame(spark, rows), labels, Q.Params(order=3)).collect()}
    for k in (0, 7, 1003, 2001):
        text = Q.START * 2 + next(t for i, t, _ in rows if i == k)
        loss = -sum(math.log(p(text[i : i + 3])) for i in range(len(text) - 2)) / (len(text) - 2)
        assert got[k].perplexity == pytest.approx(math.exp(loss), rel=1e-4)


def test_odd_rows_and_empty_tables(spark, odd_rows):  # noqa: F811
    rows, labels = table(spark)
    both = [*odd_rows, *rows]
    got = Q.assess(frame(spark, both), labels).collect()
    assert len(got) == len(both)
    assert all(r.perplexity is None and r.accepted for r in got if not r.text)
    none = spark.createDataFrame([], SCHEMA)
    assert all(r.accepted and r.perplexity_limit is None for r in Q.assess(frame(spark, odd_rows), none).collect())
    assert Q.assess(frame(spark, []), labels).collect() == []


def test_runs_leave_a_task_in_small_batches_and_each_once(spark, monkeypatch):
    monkeypatch.setattr(Q, "_BATCH_GRAMS", 40)
    tasks = []
    plain = type(spark.range(0)).mapInArrow
    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", lambda df, f, kind: (tasks.append(f), plain(df, f, kind))[1])
    Q._grams(spark.createDataFrame([("x",)], "text string"), 3)
    texts = ["".join(random.Random(k).choices("abcdefgh", k=200)) for k in range(5)]
    batches = list(tasks[0]([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    assert max(len(b) for b in batches) <= 40 < sum(len(b) for b in batches)
    padded = [Q.START * 2 + t for t in texts]
    wanted = Counter(t[k : k + 3] for t in padded for k in range(len(t) - 2))
    assert {g: n for b in batches for g, n in zip(*b.to_pydict().values(), strict=True)} == wanted


def test_a_lookup_takes_little_more_than_its_runs():
    keys = np.unique(np.random.default_rng(1).integers(1, 1 << 64, 1_100_000, dtype=np.uint64))
    keys[-2:] = (1 << 64) - 2, (1 << 64) - 1
    values = np.arange(1, len(keys) + 1, dtype=np.float32)
    lookup = Q._Lookup(keys, values)
    assert lookup.keys.nbytes < 3 * keys.nbytes
    assert (lookup(keys) == values).all()
    assert lookup(np.array([keys[5] + 1, 3], np.uint64)).tolist() == [0, 0]
