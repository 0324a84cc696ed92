import hashlib
import re

from colweave.llm.exact_dedup import exact_duplicates

from llm_rows import frame, odd_rows, words  # noqa: F401


def brute(rows):
    bare = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, _ in rows]
    out = []
    for k, (doc_id, _, _) in enumerate(rows):
        group = [i for i, b in enumerate(bare) if b == bare[k]]
        best = min(group, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        out.append((doc_id, rows[best][0], len(group), hashlib.sha256(bare[k].encode()).hexdigest()))
    return out


def key(row):
    return tuple(("", -1) if v is None else (str(v), 0) for v in row)


def check(spark, rows):
    got = exact_duplicates(frame(spark, rows)).collect()
    plain = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert sorted(plain, key=key) == sorted(brute(rows), key=key)
    # One row of every group stays.
    stay = [r.text_sha256 for r in got if r.kept]
    assert len(stay) == len(set(stay)) == len({r.text_sha256 for r in got})
    return got


def test_odd_rows(spark, odd_rows):  # noqa: F811
    check(spark, odd_rows)


def test_ties_blanks_and_prefixes(spark):
    base = words(700, 4)
    rows = [(k, base[: 50 * k] if k % 3 else base, "en") for k in range(40)]
    rows += [(100, base.replace(" ", "\n"), "en"), (101, base + " ", "en"), (102, "x" * 32, None), (103, "x" * 32, None), (104, "x" * 288, None),
             (105, "x" * 288, None), (106, "x" * 289, None), (107, "é" * 20, None), (108, "é " * 20, None)]
    got = check(spark, rows)
    assert {r.keep_id for r in got if r.doc_id in (0, 3, 100, 101)} == {101}


def test_empty_table(spark):
    assert exact_duplicates(frame(spark, [])).collect() == []
