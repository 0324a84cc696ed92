import re

from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm.license_scan import BASE, TEMPLATES, Params, scan

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    found = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in BASE:
        parts = phrase.split()
        for k in range(len(found)):
            if found[k : k + len(parts)] == parts:
                at.append(k)
                labels.add(label)
    return len(found), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_phrases_against_brute_force(spark, odd_rows):  # noqa: F811
    rows = [
        *odd_rows, (20, "CC-BY 4.0, cc by; CC\nBY. all rights reserved all rights reserved", None), (21, "cc", None), (22, "by cc", None),
        (23, "GENERAL  public-License é general publicé license", None), (24, "cc by " * 5000, None), (25, "all rights", None), (26, "reserved", None),
    ]
    got = scan(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_base, r.first_word or -1, r.last_word or -1, r.base_labels) for r in got) == sorted(
        (i or -1, n, b, lo or -1, hi or -1, labels) for (i, t, _) in rows for n, b, lo, hi, labels in [brute(t)]
    )
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in got)


def test_templates_are_found_and_verified(spark):
    rows = [(k, f"{words(300, k)} {t.text} {words(300, 100 + k)}", "en") for k, t in enumerate(TEMPLATES)]
    rows += [(1000 + k, words(400, 500 + k), "en") for k in range(200)]
    # The same rare words without the mandatory phrase, and spread out.
    mit = next(t for t in TEMPLATES if t.text.startswith("Permission is hereby"))
    rows += [(2000, " ".join(reversed(mit.text.split())), "en"), (2001, " ".join(f"{w} {words(4, k)}" for k, w in enumerate(mit.text.split())), "en")]
    got = {r.doc_id: r for r in scan(frame(spark, rows), Params()).collect()}
    for k, t in enumerate(TEMPLATES):
        assert t.label in got[k].labels.split(","), t
        assert any(m.label == t.label and abs(m.start - 300) <= 2 and m.coverage > 0.99 for m in got[k].matches)
    assert not any(got[k].labels for k in got if k >= 1000)


def test_empty_table(spark):
    assert scan(frame(spark, [])).collect() == []
