from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colweave.llm.shard import Params, _below, _bounds, _key, shard

from llm_rows import frame, odd_rows, words  # noqa: F401


def shards_of(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.shard].append(r)
    return found


def check(spark, rows, p=None):
    got = shard(frame(spark, rows), p).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((i or -1, t or "") for i, t, _ in rows)
    for own in shards_of(got).values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(r["size"] == len((r.text or "").encode()) + 8 and r.node == "y" for r in got)
    return got


def test_sizes_are_near_equal(spark):
    rows = [(k, words(20 + k % 7, k), "en") for k in range(2000)]
    got = check(spark, rows, Params(shards=8, tolerance=0.01))
    sizes = [sum(r["size"] for r in own) for own in shards_of(got).values()]
    largest = max(r["size"] for r in got)
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * largest


def test_a_hot_text_is_cut(spark):
    same = words(30, 1)
    rows = [(k, same if k % 2 else words(30, k), "en") for k in range(1200)]
    got = check(spark, rows, Params(shards=6))
    sizes = [sum(r["size"] for r in own) for own in shards_of(got).values()]
    assert len(sizes) == 6 and max(sizes) < 1.1 * min(sizes)
    # Equal texts lie together: each shard but the hot ones holds whole groups.
    order = sorted((r.shard, r.slot, r.text) for r in got)
    texts = [t for _, _, t in order]
    assert sum(a != b for a, b in zip(texts, texts[1:], strict=False)) + 1 == len(set(texts))


def test_odd_rows_and_empty_table(spark, odd_rows):  # noqa: F811
    check(spark, odd_rows, Params(shards=3))
    assert shard(frame(spark, [])).collect() == []


def test_names_of_the_operator_as_input_columns(spark):
    taken = ["part", "PART_", "text_hash", "id_order", "_shard_high", "high", "low", "bucket"]
    table = frame(spark, [(k, words(20, k), "en") for k in range(200)]).withColumns({name: F.lit(name) for name in taken})
    got = shard(table, Params(shards=4))
    assert sorted(got.columns) == sorted([*table.columns, "shard", "slot"])
    assert all([r[name] for name in taken] == taken for r in got.collect())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(-3, 3), st.integers(-9, 9)), max_size=30), st.lists(st.tuples(st.integers(-4, 4), st.integers(-10, 10)), max_size=40))
def test_cuts_below_a_key(cuts, rows):
    cuts = sorted(_key(h, l) for h, l in cuts)
    high, low = np.array(rows, np.int64).reshape(-1, 2).T
    assert _below(high, low, _bounds(cuts)).tolist() == [sum(c <= _key(h, l) for c in cuts) for h, l in rows]


def test_order_against_a_plain_sort(spark):
    """Shards and slots are those of one sorted list that is cut at the shards' first rows."""
    rows = [(k % 150, words(5 + k % 40, k % 90), None) for k in range(400)]
    table = frame(spark, rows)
    hashes = {r.text: r.h for r in table.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    got = shard(table, Params(shards=5)).collect()
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [(hashes[r.text], r.doc_id) for r in order] == sorted((hashes[t], i) for i, t, _ in rows)
    sizes = [sum(r["size"] for r in own) for own in shards_of(got).values()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2 * (max(r["size"] for r in got) + 0.01 * sum(sizes) / 20)
