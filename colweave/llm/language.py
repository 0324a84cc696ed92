"""Language of a text: sparse multinomial regression on TF-IDF of character n-grams, trained by FTRL, with a calibrated temperature."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.tables import discard, settle
from colweave.llm.text import slices

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    """N-grams of 1 to ``longest`` characters are hashed to 2^``bits`` features.

    ``sample_rows`` is the documented bound on the labelled rows that the
    classifier is fitted on (about as many, drawn by a hash of doc_id); document
    frequencies and the temperature use all labelled rows of their part. One in ``calibrate`` labelled rows sets
    the temperature and is never fitted on. ``shards`` learners run side by side and are
    averaged after each of ``rounds`` passes. ``alpha`` and ``beta`` set the learning rate, ``l1`` and ``l2`` the penalties.
    """

    longest: int = 3
    bits: int = 15
    sample_rows: int = 20_000
    calibrate: int = 10
    shards: int = 6
    rounds: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


def _features(texts: list[str | None], p: Params) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """(features, their counts) of every text; nothing for a text without a letter."""
    shift = np.uint64(64 - p.bits)
    for text in texts:
        if not text or not _LETTER.search(text):
            yield None
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        total = np.zeros(1 << p.bits, np.int64)
        run = np.zeros(len(codes), np.uint64)
        for size in range(1, min(p.longest, len(codes)) + 1):
            run = run[: len(codes) - size + 1] * _BASE + codes[size - 1 :] + np.uint64(1)
            total += np.bincount(((run * _BASE) >> shift).astype(np.int64), minlength=1 << p.bits)
        at = np.flatnonzero(total)
        yield at, total[at]


def _weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / (np.sqrt((x * x).sum()) or 1.0)


def _frequencies(labelled: DataFrame, p: Params) -> tuple[int, np.ndarray]:
    """(texts, texts that hold each feature) over all labelled rows; one vector per task."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(1 << p.bits, np.int64), 0
        for part in slices(batches, "text"):
            for found in _features(part.column("text").to_pylist(), p):
                if found is not None:
                    held[found[0]] += 1
                    n += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([n, *held[at]], pa.int64())], names=["feature", "n"])

    held = np.zeros(1 << p.bits, np.int64)
    n = 0
    for row in labelled.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        if row.feature < 0:
            n = row.n
        else:
            held[row.feature] = row.n
    return n, held


def _solved(z: np.ndarray, n: np.ndarray, p: Params) -> np.ndarray:
    """Weights that the sums of gradients stand for, under both penalties."""
    free = np.sign(z) * np.maximum(np.abs(z) - p.l1, 0)
    return -free / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _fit(sample: DataFrame, languages: list[str], idf: np.ndarray, p: Params) -> np.ndarray:
    """Weights (feature x language) of the regularised leader over the sample."""
    k = len(languages)
    number = {name: i for i, name in enumerate(languages)}
    z, n = np.zeros((1 << p.bits, k)), np.zeros((1 << p.bits, k))

    def learner(z0: np.ndarray, n0: np.ndarray):  # noqa: ANN202
        def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z, n, rows = z0.copy(), n0.copy(), 0
            for part in slices(batches, "text"):
                for found, lang in zip(_features(part.column("text").to_pylist(), p), part.column("lang").to_pylist(), strict=True):
                    if found is None:
                        continue
                    at, x = found[0], _weighted(*found, idf)
                    w = _solved(z[at], n[at], p)
                    error = _softmax(x @ w)
                    error[number[lang]] -= 1
                    g = x[:, None] * error
                    z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / p.alpha * w
                    n[at] += g * g
                    rows += 1
            if rows:
                used = np.flatnonzero(n.any(1))
                where = np.repeat(used, k)
                which = np.tile(np.arange(k), len(used))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, t) for a, t in ((np.append(where, -1), pa.int32()), (np.append(which, 0), pa.int32()),
                     (np.append(z[where, which], 1.0), pa.float64()), (np.append(n[where, which], 0.0), pa.float64()))],
                    names=["feature", "language", "z", "n"],
                )

        return learn

    for _ in range(p.rounds):
        done = sample.mapInArrow(learner(z, n), "feature int, language int, z double, n double")
        sums = done.groupBy("feature", "language").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()
        at, which = sums.column("feature").to_numpy(), sums.column("language").to_numpy()
        z_sum, n_sum = sums.column("z").to_numpy(), sums.column("n").to_numpy()
        learners = max(1.0, z_sum[at < 0].sum())
        z, n = np.zeros_like(z), np.zeros_like(n)
        real = at >= 0
        z[at[real], which[real]] = z_sum[real] / learners
        n[at[real], which[real]] = n_sum[real] / learners
    return _solved(z, n, p)


def _temperature(calibration: DataFrame, languages: list[str], weights: np.ndarray, idf: np.ndarray, p: Params) -> float:
    """The temperature of least loss on rows that were not fitted; every task sums the loss on one grid."""
    grid = np.geomspace(0.02, 20, 121)
    number = {name: i for i, name in enumerate(languages)}

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = np.zeros(len(grid))
        for part in slices(batches, "text"):
            for found, lang in zip(_features(part.column("text").to_pylist(), p), part.column("lang").to_pylist(), strict=True):
                if found is not None:
                    scores = _weighted(*found, idf) @ weights[found[0]] / grid[:, None]
                    top = scores.max(1)
                    loss += np.log(np.exp(scores - top[:, None]).sum(1)) + top - scores[:, number[lang]]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid)), pa.int32()), pa.array(loss)], names=["place", "loss"])

    rows = calibration.mapInArrow(measure, "place int, loss double").groupBy("place").agg(F.sum("loss").alias("loss")).collect()
    loss = {r.place: r.loss for r in rows}
    if not loss or not any(loss.values()):
        return 1.0
    return float(grid[min(loss, key=lambda i: (loss[i], i))])


def predict(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of documents (doc_id, text, lang).

    Learns from the text and non-null lang of the documents whose crc32(doc_id as
    text) mod 3 is not 1 (``held_out``; a row without doc_id is held out too), and predicts
    from the text alone. ``score`` is the calibrated probability of the prediction. A text that is
    null or has no letter is ``und`` with score 0, and so is every text if nothing can be learned. With
    a single language every text with letters has it, with score 1. Texts are read whole; other columns are not read.
    """
    p = params or Params()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held.alias("held_out"))
    labelled = rows.where("not held_out and lang is not null").select("doc_id", "text", "lang")
    languages = sorted(r.lang for r in labelled.groupBy("lang").agg(F.count(F.lit(1))).collect())
    total, holding = _frequencies(labelled, p)
    idf = np.log((total + 1) / (holding + 1)) + 1

    weights, heat = np.zeros((1 << p.bits, len(languages))), 1.0
    if len(languages) > 1 and total:
        drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
        apart = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(p.calibrate)) == 0
        share = min(1_000_000, int(1_000_000 * p.sample_rows / total) + 1)
        # One shard per learner; the order inside is fixed, so a lost learner learns the same again.
        sample = settle(labelled.where(~apart & (drawn < share)), "sample")
        dealt = sample.repartition(p.shards, F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(p.shards))).sortWithinPartitions(F.xxhash64("doc_id", F.lit(37)), "text")
        weights = _fit(dealt.select("text", "lang"), languages, idf, p)
        discard(sample)
        heat = _temperature(labelled.where(apart).select("text", "lang"), languages, weights, idf, p)
    weights = (weights / heat).astype(np.float32)
    able = bool(languages) and bool(total)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            names, scores = [], []
            for found in _features(part.column("text").to_pylist(), p):
                if found is None or not able:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                chance = _softmax(_weighted(*found, idf) @ weights[found[0]])
                best = int(chance.argmax())
                names.append(languages[best])
                scores.append(min(1.0, float(chance[best])))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.drop("lang").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
