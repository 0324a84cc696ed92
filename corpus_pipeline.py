"""From raw documents to piece numbers: five stages, each of which works on all that the stage before it kept.

Every stage takes (spark, docs, folder of the tables) and returns a table; all but the last return the columns of
documents. Stages read only doc_id, text and lang; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import decontaminate, line_dedup, minhash, quality, sentencepiece
from colweave.llm.queries import PIECE_MODEL
from colweave.llm.tables import bounded, discard, read, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit. Without text there is nothing to reject."""
    return quality.assess(docs, read(spark, folder, "labels")).where("accepted").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without later repeats of a passage; one that keeps less than a shingle of near_dedup is a copy and goes whole."""
    done = line_dedup.dedup_lines(docs)
    emptied = (F.col("removed_words") > 0) & ~F.col("text").rlike(r"\A[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){4}[^\x20\x09-\x0D]")
    columns = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return done.where(~F.coalesce(emptied, F.lit(False))).withColumns(columns).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near-duplicates (five-word shingles, 0.8)."""
    gone = settle(minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(bounded(gone), "doc_id", "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, read(spark, folder, "benchmark")).select(docs.columns)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as piece numbers, with their count and whether decoding gives the text back."""
    model = sentencepiece.load(PIECE_MODEL)
    both = sentencepiece.decode(sentencepiece.encode(docs, model), model)
    return both.select(
        "doc_id", "lang", "source", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_encoding),
]

# A trained model, winnowing to a fixed point, components and piece numbers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is written to the shared folder and read again."""
    folder = sf_dir.rstrip("/")
    docs, last = read(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        after = settle(stage(spark, docs, folder), name)
        if last is not None:
            discard(last)
        docs = last = after
    return STAGES[-1][1](spark, docs, folder)
