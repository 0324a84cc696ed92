"""Exact duplicates by radix partitioning on successive bytes, most significant first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.tables import settle
from colweave.llm.text import slices

BLANKS = b" \t\n\v\f\r"
FIRST_DIGIT = 32
GROWTH = 8

_NORMAL = "doc_id long, chars long, text_sha256 string, rest binary"


def _normalised(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        texts = [t or "" for t in part.column("text").to_pylist()]
        bare = [t.encode("utf-8", "surrogatepass").translate(None, BLANKS) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b in bare], pa.string()),
                pa.array(bare, pa.binary()),
            ],
            names=["doc_id", "chars", "text_sha256", "rest"],
        )


def _split(rows: DataFrame, width: int, state: str, ident: F.Column) -> DataFrame:
    """Split every open group by the next ``width`` bytes.

    ``ident`` names a new group. A group of one row is single. Rows whose
    digit is shorter than ``width`` have no bytes left, so the rows of such a
    group are equal. All others stay open with the bytes after the digit.
    """
    cut = rows.withColumn("digit", F.substring("rest", 1, width))
    groups = cut.groupBy("part", "digit").agg(F.count(F.lit(1)).alias("n"), F.min(state).alias("new")).where("n > 1")
    met = cut.join(groups, ["part", "digit"], "left")
    ended = F.octet_length("digit") < width
    state_now = F.when(F.col("n").isNull(), "single").when(ended, "equal").otherwise("open")
    return met.select(
        "doc_id", "chars", "text_sha256", state_now.alias("state"),
        F.when(F.col("n").isNotNull(), ident).alias("part"),
        F.when(F.col("n").isNotNull() & ~ended, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        *(["row"] if "row" in rows.columns else []),
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of documents (doc_id, text).

    Texts are equal when they are the same after deleting blanks (space, tab,
    line feed, vertical tab, form feed, carriage return); null counts as empty.
    The row with the most code points, then the smallest doc_id, stays; a null
    doc_id comes last, and of equal rows exactly one stays. Other columns are
    not read.

    Rows are split by the first 32 bytes, then by digits eight times as wide
    each time, until every group is a single row or has no bytes left, so texts
    of n bytes take log(n) rounds and only rows that still share a prefix are
    moved. Groups are counted map-side before the shuffle, and rows find their
    group by a join whose large partitions the engine splits; no group of
    copies is ever gathered in one place. Equality rests on the bytes alone;
    the digest is only a column of the result.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    start = texts.mapInArrow(_normalised, _NORMAL).withColumn("part", F.lit("")).withColumn("digit0", F.lit(0))
    # The first digit itself names the group; later groups are named by one of their settled rows.
    first = _split(start, FIRST_DIGIT, "digit0", F.concat(F.lit("prefix "), F.hex("digit")))
    level = settle(first.withColumn("row", F.monotonically_increasing_id()), "radix")
    closed, width = [], FIRST_DIGIT
    narrow = ["doc_id", "chars", "text_sha256", "state", "part", "row"]
    while True:
        closed.append(level.where("state != 'open'").select(narrow))
        opened = level.where("state = 'open'").drop("state")
        if opened.isEmpty():
            break
        width *= GROWTH
        level = settle(_split(opened, width, "row", F.concat(F.lit("row "), F.col("new").cast("string"))), "radix")
    done = closed[0]
    for more in closed[1:]:
        done = done.union(more)
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("gone"), "doc_id", "row")).alias("best")
    alone = done.where("state = 'single'").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    equal = done.where("state = 'equal'")
    groups = equal.groupBy("part").agg(best, F.count(F.lit(1)).alias("n"))
    return alone.union(equal.join(groups, "part").select(
        "doc_id", F.col("best.doc_id"), F.col("n"), F.col("row") == F.col("best.row"), "text_sha256"
    ))
