import re

import pytest
from llm_rows import words

from colweave.llm import queries as Q


def test_every_number_has_one_query():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in Q.queries()]
    assert sorted(numbers) == list(range(1, 14))
    assert set(Q.oracle_sql()) <= set(Q.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_twins_agree(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    got = Q.queries()[name](spark, folder)
    names = sorted(got.columns)
    want = con.execute(f"select {', '.join(names)} from ({Q.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, want))


def test_contract_columns(spark, folder):
    wanted = {
        "op2": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op4": "page_id bigint, host string, path string, rule string, verdict string",
        "op5": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
        "op8": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
        "op6": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op9": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op11": "item_id bigint, rank int, doc_id bigint, score bigint",
        "op12": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        "op13": "doc_id bigint, held_out boolean, score double, predicted int",
    }
    for name, run in Q.queries().items():
        kind = wanted.get(name.split("_")[0])
        if kind:
            assert set(kind.split(", ")) <= {f"{c} {t}" for c, t in run(spark, folder).dtypes}, name


def test_shards_cover_all_documents(spark, folder):
    got = Q.queries()["op2_histogram_sort_shards"](spark, folder).collect()
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r.doc_id for r in got} == set(documents) and len(got) == len(documents)
    assert all(r["size"] == len((documents[r.doc_id] or "").encode()) + 8 for r in got)
    assert {r.shard for r in got} <= set(range(24))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of tables with planted junk, copies, shared passages and benchmark passages."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    passage = "\n".join(words(20, 5000 + k) for k in range(4))
    item = words(30, 9000)
    clean = [(k, "\n".join(words(40, 100 * k + j) for j in range(6)), "en") for k in range(60)]
    shared = [(100 + k, f"{words(70, 7000 + k)}\n{passage}\n{words(70, 7100 + k)}", "en") for k in range(5)]
    base = words(200, 42).split()
    near = [(200 + k, " ".join(base[:190] + [f"w{k}{j}" for j in range(k)]), "en") for k in range(4)]
    leak = [(300, f"{words(50, 1)}x {item} {words(50, 2)}", "en")]
    junk = [(400 + k, " ".join("#@%$"[(k + j) % 4] * 7 for j in range(80)), "en") for k in range(4)]
    odd = [(500, None, None), (501, "", "en"), (None, words(60, 777), "en")]
    rows = [(*r, "s", len(r[1] or "")) for r in [*clean, *shared, *near, *leak, *junk, *odd]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, words(25, 9999))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {r[0]: r[1] for r in rows}, passage


def test_pipeline_stage_by_stage(spark, corpus, tmp_path):
    import os

    import corpus_pipeline as P

    if not os.path.exists(Q.PIECE_MODEL):
        pytest.skip("the tokenizer file is not here")
    reader = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=Q.PIECE_MODEL)
    folder, before, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept, texts = docs.columns, {}, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        kept[name] = {r.doc_id for r in rows}
        if name != "sentencepiece":
            assert docs.columns == columns
            texts[name] = {r.doc_id: r.text for r in rows}
    clean = {*range(60), 500, 501, None}
    assert all(clean <= k for k in kept.values())
    assert not kept["quality_classifier"] & set(range(400, 404))
    after = texts["line_dedup"]
    assert passage in after[100] and not any(passage.split("\n")[0] in after[k] for k in range(101, 105))
    assert all(after[k] == before[k] for k in range(60))
    assert kept["minhash_near_dedup"] & set(range(200, 204)) == {200}
    assert 300 in kept["minhash_near_dedup"] and 300 not in kept["benchmark_decontamination"]
    last = {r.doc_id: r for r in rows}
    assert all(r.lossless for r in rows)
    assert all((last[k].ids or []) == (reader.encode(t) if t else []) for k, t in texts["benchmark_decontamination"].items())
    whole = {r.doc_id: tuple(r.ids or ()) for r in P.run(spark, folder).collect()}
    assert whole == {k: tuple(r.ids or ()) for k, r in last.items()}
