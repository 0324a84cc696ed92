import random
import re

import pytest

from colweave.llm import minhash, tables
from colweave.llm.components import components
from colweave.llm.minhash import Params, near_duplicates
from colweave.llm.tables import settle_few

from llm_rows import frame, odd_rows, words  # noqa: F401


def shingle_set(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def brute(rows, size):
    """doc_id -> (set size, smallest doc_id reachable)"""
    ids = sorted(i for i, _, _ in rows if i is not None)
    sets = {i: shingle_set(t, size) for i, t, _ in rows if i is not None}
    head = {i: i for i in ids}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(text, changes, seed):
    rng, parts = random.Random(seed), text.split()
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = f"new{rng.randrange(10**6)}"
    return " ".join(parts)


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, size):
    rows = []
    for family in range(6):
        base = words(120, family)
        rows += [(100 * family + k, edited(base, k % 9, 50 * family + k), "en") for k in range(14)]
        rows += [(100 * family + 50, base.upper(), "en"), (100 * family + 51, base, "en")]
    # A chain: each is near the next, the ends are not near each other.
    step = words(160, 99).split()
    rows += [(900 + k, " ".join(step[6 * k : 6 * k + 90]), "en") for k in range(10)]
    expected = brute(rows, size)
    got = near_duplicates(frame(spark, rows), Params(words=size, block=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_odd_rows(spark, odd_rows):  # noqa: F811
    got = near_duplicates(frame(spark, odd_rows)).collect()
    assert len(got) == len(odd_rows)
    found = {(r.doc_id, r.n_shingles): r for r in got}
    assert found[5, 29_996].component_id == 4 and not found[5, 29_996].kept and found[4, 29_996].kept
    assert found[7, 1].component_id == 6 and found[1, 0].kept and found[2, 0].kept and found[3, 0].kept
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 200), (None, 3), (300, 301), (301, 300), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_small_tables_go_on_as_one_partition(spark, monkeypatch):
    parts = {}

    def kept(df, name, *rows):
        found = settle_few(df, name, *rows)
        parts[name] = found.rdd.getNumPartitions()
        return found

    monkeypatch.setattr(minhash, "settle_few", kept)
    texts = [(k, edited(words(120, k // 10), k % 3, k), "en") for k in range(60)]
    expected = brute(texts, 2)
    for limit in (tables.ONE_TASK_ROWS, 0):
        monkeypatch.setattr(settle_few, "__defaults__", (limit,))
        got = near_duplicates(frame(spark, texts), Params(words=2, block=4)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
        assert {"ids", "clusters", "crowded", "met", "pairs", "stars", "placed", "rest", "joined", "linked"} <= set(parts)
        assert limit == 0 or set(parts.values()) == {1}
