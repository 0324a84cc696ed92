"""One registered query per operator of this folder, with production parameters over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import (
    decontaminate, exact_dedup, language, license_scan, line_dedup, merkle, minhash, quality, search, sentencepiece, shard,
    toxicity, url_rules,
)
from colweave.llm.tables import read

# A parameter of the tokenizer query; the file is not part of the library.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(spark, folder.rstrip("/"))

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The same rows as DuckDB SQL where SQL can express them at the size of whole tables."""
    return {"op4_url_filters": _url_sql(), "op5_exact_dedup": _EXACT_SQL, "op11_ranked_search": _SEARCH_SQL, "op12_merkle_manifest": _MERKLE_SQL}


_EXACT_SQL = """
with t as (
  select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as bare
  from documents
), g as (
  select *, count(*) over (partition by bare) as group_size,
    first_value(doc_id) over (partition by bare order by chars desc, doc_id) as keep_id
  from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from g
"""


_TERMS = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"

_SEARCH_SQL = f"""
with d as (select row_number() over () as row, doc_id, text from documents where text is not null),
words as (select row, {_TERMS} as term from d),
tf as (select row, term, count(*) as tf from words group by all),
sizes as (select row, sum(tf)::bigint as n from tf group by row),
total as (select count(*) as texts, sum(n)::bigint as terms from sizes),
weights as (
  select term, floor(1000 * ln((2 * any_value(texts) + 2)::double / (2 * count(*) + 1)))::bigint as w from tf, total group by term
),
asked as (select item_id, {_TERMS} as term from benchmark),
scores as (
  select item_id, doc_id, d.row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * texts) // terms))))::bigint as score
  from asked join weights using (term) join tf using (term) join sizes using (row) join d using (row), total group by all
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scores where score > 0 qualify rank <= 10
"""

# CRC-32 has no DuckDB function: its table of 256 remainders is made from the polynomial, then the digits run through it.
_MERKLE_SQL = """
with recursive crc_table as (
  select list(list_reduce(list_prepend(k, range(8)), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by k) as t
  from range(256) r(k)
), base as (
  select doc_id, lang, case when doc_id is null then false else xor(list_reduce(
      list_prepend(4294967295, [ascii(x)::bigint for x in string_split(doc_id::varchar, '')]),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 end as bad,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(text) || ':' || text, '-') as tail, n_chars
  from documents, crc_table
), leaves as (
  select doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail) as other, bad
  from base
), placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n from leaves
), tree(lang, level, i, n, h) as (
  select lang, 0, i, n, leaf from placed
  union all
  select lang, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by i)) from tree where n > 1 group by lang, level, i // 2
), tops as (
  select lang, level as height, h as subroot, row_number() over (order by lang nulls first) - 1 as j, count(*) over () as m from tree where n = 1
), crown(level, i, n, h) as (
  select 0, j, m, subroot from tops
  union all
  select level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by i)) from crown where n > 1 group by level, i // 2
), whole as (select h as root, level as height from crown where n = 1),
own as (
  select p.doc_id, p.lang, p.i, t.j, t.height, t.subroot, w.root, w.height as above, leaf, case when bad then other else leaf end as now, row_number() over () as row
  from placed p join tops t on p.lang is not distinct from t.lang, whole w
), steps as (
  select row, k, s.h as sib, (own.i >> k) & 1 as side from own, range(64) r(k)
    left join tree s on s.lang is not distinct from own.lang and s.level = k and s.i = xor(own.i >> k, 1) where k < height
  union all
  select row, height + k, s.h, (own.j >> k) & 1 from own, range(64) r(k)
    left join crown s on s.level = k and s.i = xor(own.j >> k, 1) where k < above
), folded(row, k, h) as (
  select row, 0, now from own
  union all
  select f.row, f.k + 1, sha256(case when side = 1 then coalesce(sib, '') || h else h || coalesce(sib, '') end)
  from folded f join steps s on s.row = f.row and s.k = f.k
), proofs as (select row, sha256(coalesce(string_agg(sib, '' order by k), '')) as proof from steps group by row)
select doc_id, leaf, subroot, root, coalesce(proof, sha256('')) as proof_sha256, f.h as folded_root, f.h = root as verified
from own join folded f on f.row = own.row and f.k = own.height + own.above left join proofs p on p.row = own.row
"""


def _url_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ", ".join(
        f"({', '.join(quoted(x) for x in (r.name, r.verdict, r.subject, r.pattern))})"
        for r in (*url_rules.PAGE_RULES, *url_rules.PATTERN_RULES)
    )
    lower = f"{quoted(url_rules.UPPER)}, {quoted(url_rules.LOWER)}"
    return f"""
with rules(name, verdict, subject, pattern) as (values {rules}),
u as (
  select page_id, translate(regexp_extract(coalesce(url, ''), {quoted(url_rules.AFTER_SCHEME)}, 1), {lower}) as host,
    regexp_extract(coalesce(url, ''), {quoted(url_rules.AFTER_SCHEME)}, 2) as path,
    translate(regexp_extract(coalesce(url, ''), {quoted(url_rules.WHOLE)}, 1), {lower}) as rest
  from pages
),
fits as (
  select u.*, arg_max(name, length(name)) filter (subject = 'page') as rule,
    arg_max(verdict, length(name)) filter (subject = 'page') as rule_verdict,
    min(name) filter (subject = 'whole') as pattern, arg_min(verdict, name) filter (subject = 'whole') as pattern_verdict
  from u left join rules on rest <> '' and case when subject = 'page'
    then regexp_matches(host || path, pattern) else regexp_matches(rest, pattern) end
  group by all
)
select page_id, host, path, rule, coalesce(rule_verdict, pattern_verdict, 'allow') as verdict, pattern from fits
"""


@query
def op9_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates of whole documents on two-word shingles."""
    return minhash.near_duplicates(read(spark, folder, "documents"), minhash.Params(words=2))


@query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's perplexity, its language's limit, and whether it is accepted."""
    found = quality.assess(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return found.select("doc_id", "lang", "perplexity", "perplexity_limit", "accepted")


@query
def op2_histogram_sort_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes."""
    placed = shard.shard(read(spark, folder, "documents"), shard.Params(shards=24))
    return placed.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the lines that repeat an earlier passage taken out."""
    done = line_dedup.dedup_lines(read(spark, folder, "documents"))
    return done.select(
        "doc_id", "removed_lines", F.size("removed_lines").alias("n_removed"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes_left"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )


@query
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict under the page rules, else under the pattern rules."""
    rules = url_rules.rule_table(spark, [*url_rules.PAGE_RULES, *url_rules.PATTERN_RULES])
    return url_rules.judge(read(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict", "pattern")


@query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies among all documents, blanks aside."""
    return exact_dedup.exact_duplicates(read(spark, folder, "documents"))


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    return language.predict(read(spark, folder, "documents"))


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row for every document and benchmark item that it holds."""
    marked = decontaminate.mark(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"))
    found = marked.select("doc_id", F.explode("contaminated_by").alias("c"))
    return found.select("doc_id", "c.item_id", "c.similarity", "c.start", "c.words")


@query
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and passages in every document."""
    return license_scan.scan(read(spark, folder, "documents")).drop("matches")


@query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again: its pieces counted and hashed, and whether the text came back."""
    model = sentencepiece.load(PIECE_MODEL)
    encoded = sentencepiece.encode(read(spark, folder, "documents").select("doc_id", "text"), model)
    both = sentencepiece.decode(encoded, model)
    return both.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("pieces_hash"),
        F.crc32(F.coalesce("decoded", F.lit(""))).alias("decoded_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's inclusion proof, checked against rows whose length was tampered with where 7 divides the CRC of doc_id."""
    tampered = {"n_chars": F.col("n_chars").cast("long") + 1}
    return merkle.verify(read(spark, folder, "documents"), tampered, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents that answer every benchmark item best."""
    return search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """How toxic every document is, learned from two thirds of the labelled ones."""
    return toxicity.score(read(spark, folder, "documents"), read(spark, folder, "labels"))
