import numpy as np
import pyarrow as pa
from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm import decontaminate as D


def items(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, size string")


BENCH = [(k, words(20 + 2 * k, 7000 + k), ) for k in range(15)] + [(50, None), (51, ""), (52, "ab cd ef"), (53, words(30, 7005)), (53, words(30, 7005))]


def brute(texts, bench, p):
    """Best similarity of every item over all windows of its size, without fingerprints."""
    index = D.Index([i for i, _ in bench], [t for _, t in bench], p)
    out = {}
    for doc_id, text, _ in texts:
        hashed, first = D._word_hashes(pa.array([text], pa.string()))
        weights = index.weights(hashed)
        for k, size in enumerate(index.sizes.tolist()):
            best = 0.0
            for s in range(len(hashed) - size + 1 if size else 0):
                best = max(best, D.similarity(index.bag(hashed[s : s + size], weights[s : s + size]), index.bags[k]))
            if best >= p.similarity:
                out[doc_id, index.ids[k]] = round(best, 9)
    return out


def cases():
    rows = [(k, words(120, k), "en") for k in range(20)]
    for k in range(15):
        text = BENCH[k][1].split()
        rows.append((100 + k, f"{words(40, 40 + k)} {' '.join(text)} {words(40, 80 + k)}", "en"))
        rows.append((200 + k, f"{words(40, 40 + k)} {' '.join(text[1:])}, {words(40, 80 + k)}", "en"))
        rows.append((300 + k, f"{words(40, 40 + k)}\n{' '.join(text).upper()}. {words(10, k)} AB, cd: ef.", "en"))
        rows.append((400 + k, f"{words(40, 40 + k)} {' '.join(text[: len(text) // 2])} {words(40, 80 + k)}", "en"))
    return rows


def test_against_all_windows(spark):
    p = D.Params()
    rows = cases()
    got = {(r.doc_id, c.item_id): round(c.similarity, 9) for r in D.mark(frame(spark, rows), items(spark, BENCH)).collect() for c in r.contaminated_by}
    expected = brute(rows, BENCH, p)
    assert set(got) <= set(expected) and all(got[k] <= expected[k] for k in got)
    exact = {k for k, v in expected.items() if v == 1.0}
    assert len(exact) >= 30 and exact <= set(got)
    # Edited passages: the fingerprints find nearly all.
    assert len(got) >= 0.95 * len(expected)
    assert not any(d < 100 or d >= 400 for d, _ in got)


def test_blocks_of_the_benchmark_give_the_same(spark):
    rows = cases()[:50]
    found = [
        sorted((r.doc_id, c.item_id, c.start) for r in D.mark(frame(spark, rows), items(spark, BENCH), p).collect() for c in r.contaminated_by)
        for p in (D.Params(), D.Params(block_words=100))
    ]
    assert {(d, i) for d, i, _ in found[0]} == {(d, i) for d, i, _ in found[1]}


def test_candidates_are_all_pairs_within_the_radius():
    rng = np.random.default_rng(1)
    items_ = rng.integers(0, 1 << 63, 40, np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for n in rng.integers(0, 30, 400)], np.uint64)
    windows = items_[rng.integers(0, 40, 400)] ^ flips
    for radius in (0, 3, 16):
        got = set(zip(*(x.tolist() for x in D.candidates(windows, items_, radius)), strict=True))
        near = np.bitwise_count(windows[:, None] ^ items_[None]) <= radius
        assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_odd_rows_and_empty_tables(spark, odd_rows):  # noqa: F811
    marked = D.mark(frame(spark, odd_rows), items(spark, [*BENCH, (60, "two words"), (61, odd_rows[3][1])])).collect()
    assert len(marked) == len(odd_rows)
    found = sorted((r.doc_id or -1, c.item_id) for r in marked for c in r.contaminated_by)
    assert found == [(-1, 60), (4, 61), (5, 61)]
    kept = D.decontaminate(frame(spark, odd_rows), items(spark, [(60, "two words")]))
    assert kept.count() == len(odd_rows) - 1 and kept.columns == frame(spark, []).columns
    assert D.decontaminate(frame(spark, []), items(spark, BENCH)).collect() == []
    assert D.decontaminate(frame(spark, odd_rows), items(spark, [])).count() == len(odd_rows)


def test_items_that_are_longer_than_the_document(spark):
    items = [words(38, 1), words(38, 2), words(300, 3)]
    rows = [
        (1, " ".join(items[0].split()[:36]), None), (2, " ".join(items[1].split()[2:]), None), (3, " ".join(items[2].split()[:250]), None),
        (4, " ".join(items[0].split()[:20]), None), (5, " ".join(items[2].split()[:150]), None), (6, "w1 w2", None), (7, None, None),
    ]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: r.contaminated_by for r in D.mark(frame(spark, rows), benchmark).collect()}
    assert {k: [(c["item_id"], c["start"], c["words"]) for c in v] for k, v in got.items()} == {
        1: [(0, 0, 36)], 2: [(1, 0, 36)], 3: [(2, 0, 250)], 4: [], 5: [], 6: [], 7: [],
    }
    assert all(c["similarity"] >= 0.8 for v in got.values() for c in v)
    assert {r.doc_id for r in D.decontaminate(frame(spark, rows), benchmark).collect()} == {4, 5, 6, 7}


def test_edited_passages_near_the_limit_are_found(spark):
    """Replaced words at random places: of the passages whose best window lies at 0.8 to 0.9, at least 98 in 100 are found."""
    rng = np.random.default_rng(11)
    bench = [(k, words(45 + 4 * k, 8100 + k)) for k in range(24)]
    rows = []
    for k, text in bench:
        for j in range(25):
            edited = text.split()
            for at in rng.choice(len(edited), 1 + j % 3, replace=False):
                edited[at] = f"new{k}x{j}x{at}"
            rows.append((100 * k + j, f"{words(6, 60_000 + j)} {' '.join(edited)} {words(6, 61_000 + j)}", "en"))
    p = D.Params()
    index = D.Index([i for i, _ in bench], [t for _, t in bench], p)
    near = {}
    for doc_id, text, _ in rows:
        hashed, _first = D._word_hashes(pa.array([text], pa.string()))
        weights, k = index.weights(hashed), index.ids.index(doc_id // 100)
        size = int(index.sizes[k])
        best = max(D.similarity(index.bag(hashed[s : s + size], weights[s : s + size]), index.bags[k]) for s in range(len(hashed) - size + 1))
        if best >= p.similarity:
            near[doc_id] = best
    found = {r.doc_id: [c.item_id for c in r.contaminated_by] for r in D.mark(frame(spark, rows), items(spark, bench)).collect()}
    edge = [d for d, s in near.items() if s < 0.9]
    hit = [d for d in edge if found[d] == [d // 100]]
    assert len(edge) >= 150 and len(hit) >= 0.98 * len(edge)
    assert all(not found[d] for d in found if d not in near)
