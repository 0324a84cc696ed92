import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from colweave.llm import merkle
from colweave.llm.merkle import Params

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf string, path string, h string"


def frame(spark, rows):
    """Documents with more columns of clashing names."""
    return spark.createDataFrame([(*r, "t", "l", "p", "h") for r in rows], SCHEMA)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, extra=0):
    i, text, lang, source, n = row
    values = [i, source, lang, None if n is None else n + extra, text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """(root, siblings of every leaf as (before, after) per level)"""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for at, path in zip(own, paths, strict=True):
            run = at - at % fanout
            path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fanout])))
        nodes = [H(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        own = [at // fanout for at in own]
    return nodes[0], paths


def brute(rows, fanout=2):
    """Rows of verify(), sorted."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups, subroots = {}, []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = tree([leaf(r) for r in own], fanout)
        groups[lang] = own, root, paths
        subroots.append(root)
    root, tops = tree(subroots, fanout) if subroots else (None, [])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        own, subroot, paths = groups[lang]
        for r, path in zip(own, paths, strict=True):
            h = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            for before, after in path + top:
                h = H(before, h, after)
            out.append((r[0], leaf(r), subroot, root, H(*(x for step in path + top for x in step)), h, h == root))
    return sorted(out, key=str)


def check(spark, rows, params):
    got = merkle.verify(frame(spark, rows), {"n_chars": F.col("n_chars") + 1}, F.crc32(F.col("doc_id").cast("string")) % 7 == 0, params)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == brute(rows, params.fanout)
    return found


@pytest.mark.parametrize("params", [Params(), Params(fanout=3, width=9), Params(fanout=5, width=4), Params(fanout=2, width=2)])
def test_against_brute_force(spark, params):
    rows = [(k * 3 % 101 - 5, f"text {k} ü", ["en", "de", "fr"][min(2, k % 7)], None if k % 5 == 0 else f"s{k}", k if k % 4 else None) for k in range(90)]
    found = check(spark, rows, params)
    assert 0 < sum(not r[-1] for r in found) < len(found) / 2


def test_odd_rows(spark):
    long = "wörter " * 50_000
    rows = [
        (1, None, "en", None, None), (2, "", "en", "", 0), (3, long, "en", "s", len(long)), (3, long, "en", "s", len(long)), (3, "other", "en", "s", 5),
        (None, "no id", "en", "s", 5), (None, None, None, None, None), (None, None, None, None, None), (7, "x", None, "s", 1),
        (8, "y", "", "s", 1), (9, "z", "zz", "s", 1), (10, "1:a", "Zz", "-", 1), (11, "q", "é", "s", 2),
    ]
    check(spark, rows, Params())
    check(spark, rows, Params(fanout=4, width=16))


def test_one_row_and_an_empty_table(spark):
    found = check(spark, [(5, "only", "en", "s", 4)], Params())
    assert found[0][1] == found[0][2] == found[0][3] == found[0][5] and found[0][4] == H()
    assert check(spark, [], Params()) == []


def test_one_language_holds_nearly_all_and_rows_repeat(spark):
    rows = [(4, "same", "en", "s", 4)] * 200 + [(k, f"t{k}", "en" if k % 50 else "de", "s", 1) for k in range(300)]
    check(spark, rows, Params())


def test_places_and_more_columns(spark):
    rows = [(k, f"t{k}", "en", "s", k) for k in (5, 3, 9, 1)]
    got = {r.doc_id: r for r in merkle.manifest(frame(spark, rows), {"twice": F.col("n_chars") * 2}).collect()}
    assert {k: (r.place, r.twice, r.lang) for k, r in got.items()} == {1: (0, 2, "en"), 3: (1, 6, "en"), 5: (2, 10, "en"), 9: (3, 18, "en")}
