import random

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import frame, odd_rows, words  # noqa: F401
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from colweave.llm import line_dedup
from colweave.llm.line_dedup import Params, dedup_lines, winnow
from colweave.llm.tables import settle, settle_by


def passage(n, seed, lines=4):
    return "\n".join(words(n // lines, 1000 * seed + k) for k in range(lines))


def runs(text, least):
    """All runs of consecutive lines with words, shortest for their start, of ``least`` words."""
    found = [tuple(line.lower().split()) for line in (text or "").split("\n") if line.split()]
    out = set()
    for a in range(len(found)):
        total = 0
        for b in range(a, len(found)):
            total += len(found[b])
            if total >= least:
                out.add(tuple(found[a : b + 1]))
                break
    return out


def test_no_long_run_is_left_twice_and_first_places_stay(spark):
    rng = random.Random(3)
    shared = [passage(60 + 15 * k, k, 1 + k % 5) for k in range(8)]
    rows = []
    for k in range(60):
        parts = [passage(70, 100 + k), *rng.sample(shared, 3), passage(80, 300 + k, 9)]
        rng.shuffle(parts)
        rows.append((k, "\n\n".join(parts), "en"))
    got = {r.doc_id: r for r in dedup_lines(frame(spark, rows)).collect()}
    seen = set()
    for k in sorted(got):
        own = runs(got[k].text, Params().sure_words)
        assert not own & seen
        seen |= own
    # Whatever goes stands in full somewhere: every line of the input is still there once.
    before = {line for _, t, _ in rows for line in t.split("\n") if line}
    assert before == {line for r in got.values() for line in r.text.split("\n") if line}
    # Lines that are not repeated stay where they were.
    for k, t, _ in rows:
        kept = [line for n, line in enumerate(t.split("\n")) if n not in set(got[k].removed_lines)]
        assert got[k].text == "\n".join(kept)
        for line in t.split("\n"):
            if sum(line in u for _, u, _ in rows) == 1:
                assert line in got[k].text
    assert got[0].removed_lines == []


def test_a_run_whose_first_place_shares_only_a_part(spark):
    a, b, c = passage(45, 1, 1), passage(60, 2, 1), passage(55, 3, 1)
    rows = [(1, a, None), (2, f"{a}\n{b}\n{c}", None), (3, f"x\n{a}\n{b}\n{c}\ny", None)]
    got = {r.doc_id: r.text for r in dedup_lines(frame(spark, rows)).collect()}
    assert got[1] == a and b in got[2] and c in got[2] and got[3] == "x\ny"


def test_short_runs_stay(spark):
    line = words(30, 1)
    rows = [(k, f"{words(60, k + 5)}\n{line}\n{words(60, k + 900)}", None) for k in range(20)]
    assert all(not r.removed_lines for r in dedup_lines(frame(spark, rows)).collect())


def test_odd_rows(spark, odd_rows):  # noqa: F811
    rows = [*odd_rows, (30, "\n".join([words(5, 1)] * 2000), None), (31, words(60, 77), None), (31, words(60, 77), None)]
    got = dedup_lines(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {(r.doc_id, r.lang): r.text for r in got}
    assert texts[4, "en"] and texts[5, "de"] == "" and texts[1, "en"] is None and texts[2, "en"] == "" and texts[3, None] == " \n\t "
    assert [r.text for r in got if r.doc_id == 31] == [words(60, 77)] * 2
    assert next(r for r in got if r.doc_id == 30).text.count("\n") < 60
    assert all((r.size, r.node, r.doc) == ("x", "y", "z") for r in got)


def test_empty_table(spark):
    assert dedup_lines(frame(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(1, 30)), min_size=1, max_size=40), st.lists(st.tuples(st.integers(0, 6), st.integers(1, 30)), max_size=10))
def test_texts_that_share_a_long_run_share_a_fingerprint(run, other):
    p = Params(least_words=20, sure_words=30)
    if sum(w for _, w in run) < p.sure_words:
        return

    def prints(lines):
        return {f for f, _, _ in winnow(np.array([(h * 7919 + w) * 2654435761 % 2**61 for h, w in lines], np.int64), np.array([w for _, w in lines]), p)}

    assert prints(run) & prints([*other, *run]) and prints(run) & prints([*run, *other])


def test_passages_that_start_and_end_inside_a_line(spark):
    rng = random.Random(8)
    shared = [words(n, 500 + n) for n in (50, 55, 64, 90, 150)]
    rows = []
    for k in range(30):
        middle = rng.choice(shared).split()
        for at in sorted(rng.sample(range(1, len(middle)), 3), reverse=True):
            middle[at - 1 : at + 1] = [rng.choice([f"{middle[at - 1]}\n{middle[at]}", f"{middle[at - 1].upper()}  {middle[at]}"])]
        rows.append((k, f"a{k} {words(30, 9000 + k)} b{k} {' '.join(middle)} c{k} {words(30, 9100 + k)} d{k}", None))
    got = {r.doc_id: r for r in dedup_lines(frame(spark, rows)).collect()}
    seen, met = set(), set()
    for k, text, _ in rows:
        left = got[k].text.lower().split()
        grams = {tuple(left[a : a + 50]) for a in range(len(left) - 49)}
        assert not grams & met
        met |= grams
        passage = " ".join(text.lower().split()).split(f"b{k} ")[1].split(f" c{k}")[0]
        if passage in seen:
            assert got[k].text == f"a{k} {words(30, 9000 + k)} b{k} c{k} {words(30, 9100 + k)} d{k}" or "\n" in got[k].text
            assert left == f"a{k} {words(30, 9000 + k)} b{k} c{k} {words(30, 9100 + k)} d{k}".split()
            assert got[k].removed_words == len(passage.split())
        else:
            assert got[k].text == text and got[k].removed_words == 0
        seen.add(passage)
    assert sum(r.removed_words > 0 for r in got.values()) == 25


def test_a_long_line_beside_many_short_ones(spark):
    long, short = words(60, 1), "\n".join(words(40, 2).split())
    rows = [(k, f"x{k} {words(20, 50 + k)}\n{body}\ny{k} {words(20, 70 + k)}", None) for k, body in enumerate([f"{long}\n{short}"] * 3 + [f"{short}\n{long}"] * 3)]
    got = {r.doc_id: r.text for r in dedup_lines(frame(spark, rows)).collect()}
    assert got[0] == rows[0][1]
    for k in (1, 2, 4, 5):
        assert got[k] == f"x{k} {words(20, 50 + k)}\ny{k} {words(20, 70 + k)}"


def test_names_of_the_operator_as_input_columns(spark):
    rows = [(k, f"x{k} {words(20, 50 + k)}\n{words(60, 1)}", None) for k in range(3)]
    taken = ["line_doc", "LINE_DOC_", "_line_doc", "starts", "stops", "gram", "first", "spots", "fresh"]
    table = frame(spark, rows).withColumns({name: F.lit(name) for name in taken})
    got = dedup_lines(table)
    assert got.columns == [*table.columns, "removed_lines", "removed_words"]
    assert sorted((r.doc_id, r.removed_words) for r in got.collect()) == [(0, 0), (1, 60), (2, 60)]
    assert all([r[name] for name in taken] == taken for r in got.collect())


def test_repeated_grams_are_those_of_more_than_one_row(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_SHARD_GRAMS", 500)
    rng = np.random.default_rng(4)
    grams = np.concatenate([rng.integers(-(2**63), 2**63 - 1, 3000), np.full(2000, -7)])
    grams = np.concatenate([grams, grams[:400], grams[:100]])
    rng.shuffle(grams)
    table = settle(spark.createDataFrame([(int(g),) for g in grams], "gram long").repartition(7), "grams")
    got = [r.gram for r in line_dedup._repeated(table).collect()]
    values, many = np.unique(grams, return_counts=True)
    assert sorted(got) == values[many > 1].tolist()
    assert line_dedup._repeated(settle(table.limit(0), "none")).collect() == []


def test_texts_are_moved_once(spark):
    texts = settle_by(spark.createDataFrame([(k, str(k)) for k in range(50)], "doc long, text string"), "doc", F.length("text"), "moved")
    few = spark.createDataFrame([(k, k) for k in range(0, 50, 3)], "doc long, n long").groupBy("doc").agg(F.max("n").alias("n"))
    joined = texts.join(few.hint("shuffle_hash"), "doc")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    assert sorted(r.n for r in joined.collect()) == list(range(0, 50, 3))


def test_later_rounds_hash_only_texts_with_a_new_cut(spark, monkeypatch):
    a, b, c, d = passage(30, 1, 1), passage(90, 2, 1), passage(30, 3, 1), passage(80, 4, 1)
    rows = [(1, b, "en"), (2, f"{a} {b} {c}", "en"), (3, f"{a} {c}", "en")]  # a c stands twice when b has gone
    rows += [(k, f"{d} {passage(60, k, 1)}", "en") for k in range(10, 20)]
    hashed, whole = [], line_dedup._fingerprints

    def counted(texts, p):
        hashed.append(texts.count())
        return whole(texts, p)

    monkeypatch.setattr(line_dedup, "_fingerprints", counted)
    got = {r.doc_id: r.removed_words for r in dedup_lines(frame(spark, rows)).collect()}
    assert hashed == [13, 10, 1]
    assert [got[k] for k in (1, 2, 3)] == [0, 90, 60] and [got[k] for k in range(10, 20)] == [0] + [80] * 9


def test_runs_and_older_cuts_become_one_list_in_words_of_the_text():
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([7, 8, 9], pa.int64()), pa.array([[{"start": 1, "stop": 4}, {"start": 9, "stop": 10}], None, [{"start": 0, "stop": 2}]], kind),
            *(pa.array(x, pa.list_(pa.int32())) for x in ([[2, 8], [3], None], [[5, 9], [6], None])),
        ],
        names=["doc", "runs", "starts", "stops"],
    )
    got = next(line_dedup._united([batch])).to_pydict()
    assert got == {"doc": [7, 8, 9], "starts": [[1, 8, 13], [3], [0]], "stops": [[7, 9, 14], [6], [2]], "now": [True, False, True]}


def test_words_go_with_the_blanks_after_them_and_lines_without_words_left_whole():
    text = "a  b c \n d e\n\n\tf g  h\ni".encode()
    assert line_dedup._rewritten(text, [1, 3, 6], [2, 5, 8]) == (b"a  c \n\n\tf\ni", [1], 5)
    assert line_dedup._rewritten(text, [0], [9]) == (b"", [0, 1, 3, 4], 9)
