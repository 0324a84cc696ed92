import random
import zlib

from llm_rows import frame, odd_rows, words  # noqa: F401

from colweave.llm.language import Params, predict

LETTERS = {"aa": "abcdefgh", "bb": "abijklmn", "cc": "ghnopqrs"}


def text(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_held_out_accuracy_and_calibration(spark):
    rows = [(k, text(lang := sorted(LETTERS)[k % 3], k), lang if k % 11 else None) for k in range(900)]
    got = predict(frame(spark, rows), Params(bits=12)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    right = sum(r.lang_pred == sorted(LETTERS)[r.doc_id % 3] for r in held)
    assert right >= 0.99 * len(held) and 0.9 < sum(r.score for r in held) / len(held) <= 1


def test_the_label_is_no_input(spark):
    rows = [(k, text(lang := sorted(LETTERS)[k % 3], k), lang) for k in range(300)]
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    swapped = [(i, t, "aa" if i in held else lang) for i, t, lang in rows]
    both = [sorted(predict(frame(spark, r), Params(bits=12)).collect()) for r in (rows, swapped)]
    assert both[0] == both[1]


def test_odd_rows(spark, odd_rows):  # noqa: F811
    rows = [*odd_rows, (40, "123 !?", "en"), *[(100 + k, text(lang := sorted(LETTERS)[k % 2], k), lang) for k in range(60)]]
    got = predict(frame(spark, rows), Params(bits=12)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        if r.doc_id in (1, 2, 3, 40):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred != "und"
        else:
            assert r.held_out


def test_one_language_none_and_an_empty_table(spark):
    one = predict(frame(spark, [(k, words(5, k), "en") for k in range(20)])).collect()
    assert all((r.lang_pred, r.score) == ("en", 1.0) for r in one)
    none = predict(frame(spark, [(k, words(5, k), None) for k in range(20)])).collect()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in none)
    assert predict(frame(spark, [])).collect() == []
