"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters, trained on trusted text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.tables import bounded, discard, settle
from colweave.llm.text import SMALL_SLICE_BYTES, mix, slices

START, NUL = "\x02", "\x01"
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Runs that a task holds before it merges or passes them on, and runs of a batch that it passes on.
_HELD_GRAMS = 1_000_000
_BATCH_GRAMS = 50_000


@dataclass(frozen=True)
class Params:
    """Runs of ``order`` characters; a document is rejected above the ``quantile`` of trusted text of
    its language that the model has not seen.

    One in ``hold_out`` trusted documents sets the limits instead of training.
    A task looks up at most ``shard_rows`` rows of the model at a time, and the driver passes on at most
    ``shards_per_pass`` such shards before the sums so far are written down. Trusted ids up to
    ``broadcast_ids`` travel to the tasks, more are joined by shuffle.
    """

    order: int = 5
    quantile: float = 0.995
    hold_out: int = 5
    shard_rows: int = 1_500_000
    shards_per_pass: int = 4
    broadcast_ids: int = 2_000_000


def _codes(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(characters of all texts, each after order - 1 start marks; offsets per text)."""
    pad = START * (order - 1)
    marked = [pad + t.replace("\0", NUL) if t else "" for t in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """One hash per place where ``order`` characters start."""
    n = max(0, len(codes) - order + 1)
    out = np.zeros(n, np.uint64)
    for k in range(order):
        out = out * _BASE + codes[k : k + n]
    return mix(out)


def _inside(codes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Whether the run from each place on lies in one text."""
    n = max(0, len(codes) - order + 1)
    ok = np.ones(n, bool)
    for k in range(1, order):
        cut = offsets[1:-1] - k
        ok[cut[(cut >= 0) & (cut < n)]] = False
    return ok


def _grams(docs: DataFrame, order: int) -> DataFrame:
    """(gram, n): the distinct runs of every task's texts with their counts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for part in slices(batches, "text", SMALL_SLICE_BYTES):
            codes, offsets = _codes(part.column("text").to_pylist(), order)
            ok = np.flatnonzero(_inside(codes, offsets, order))
            found, at, n = np.unique(_hashes(codes, order)[ok], return_index=True, return_counts=True)
            if not len(at):
                continue
            rows = np.lib.stride_tricks.sliding_window_view(codes, order)[ok[at]]
            held.append((found, np.ascontiguousarray(rows).view(f"<U{order}").reshape(len(at)), n))
            if sum(len(found) for found, _, _ in held) > _HELD_GRAMS:
                held = [merged(held)]
                if len(held[0][0]) > _HELD_GRAMS // 2:
                    yield from table(held.pop())
        if held:
            yield from table(merged(held))

    def merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, names, counts = (np.concatenate(column) for column in zip(*held, strict=True))
        held.clear()
        by_key = np.argsort(keys, kind="stable")
        keys = keys[by_key]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], names[by_key[first]], np.add.reduceat(counts[by_key], first)

    def table(runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, names, counts = runs
        by_name = np.argsort(names)
        for start in range(0, len(by_name), _BATCH_GRAMS):
            at = by_name[start : start + _BATCH_GRAMS]
            yield pa.RecordBatch.from_arrays([pa.array(names[at].tolist(), pa.string()), pa.array(counts[at], pa.int64())], names=["gram", "n"])

    return docs.select("text").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Per order (weights: gram, alpha) and (rests: context, gamma); of order 1 a constant rest.

    ``settled`` are the tables to delete when the model is done with.
    """

    weights: list[DataFrame]
    rests: list[DataFrame]
    floor: float
    settled: list[DataFrame]

    def forget(self) -> None:
        discard(*self.settled)


def _discounts(counts: DataFrame) -> list[float]:
    """Modified discounts for counts of 1, 2 and more, from how many grams have counts of 1 to 4."""
    seen = {int(r["c"]): r["n"] for r in counts.where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [seen.get(k, 0) for k in range(1, 5)]
    share = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = []
    for k in range(3):
        exact = (k + 1) - (k + 2) * share * n[k + 1] / n[k] if n[k] else 0.5 * (k + 1)
        out.append(min(max(exact, 0.1), k + 0.9))
    return out


def train(trusted: DataFrame, order: int) -> Model:
    """Count runs of ``order`` characters of all trusted texts and discount every order.

    The highest order has plain counts; a lower one counts the distinct characters
    that precede a run. All tables are grouped by the run itself or its context; a context
    has at most as many rows as there are characters.
    """
    weights, rests, settled = [], [], []
    counts = settle(_grams(trusted, order).select("gram", F.col("n").alias("c")), "grams")
    floor = 1.0
    for k in range(order, 0, -1):
        settled.append(counts)
        d1, d2, d3 = _discounts(counts)
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        marked = counts.select("gram", "c", discount.alias("d"))
        if k == 1:
            total, mass, letters = marked.agg(F.sum("c"), F.sum("d"), F.count(F.lit(1))).first()
            floor = (mass / total if total else 1.0) / (letters + 1)
            weights.append(marked.select("gram", ((F.col("c") - F.col("d")) / F.lit(float(total or 1))).alias("alpha")))
        else:
            context = F.substring("gram", 1, k - 1)
            sums = marked.groupBy(context.alias("context")).agg(F.sum("c").alias("total"), F.sum("d").alias("mass"))
            rests.append(sums.select("context", (F.col("mass") / F.col("total")).alias("gamma")))
            weights.append(
                marked.withColumn("context", context).join(sums, "context").select("gram", ((F.col("c") - F.col("d")) / F.col("total")).alias("alpha"))
            )
            counts = settle(counts.groupBy(F.substring("gram", 2, k - 1).alias("gram")).agg(F.count(F.lit(1)).alias("c")), "grams")
    return Model(weights[::-1], rests[::-1], floor, settled)


def probabilities(grams: DataFrame, model: Model, k: int) -> DataFrame:
    """(gram, p) of distinct runs of k characters, by joins with the counts of every order below.

    p = alpha(run) + gamma(context) * p(run without its first character). Every
    order is settled, as each is read twice: a plan stays as small as one order.
    """
    if k == 1:
        return grams.join(model.weights[0], "gram", "left").select("gram", (F.coalesce("alpha", F.lit(0.0)) + model.floor).alias("p"))
    shorter = F.substring("gram", 2, k - 1)
    needed = settle(grams.select(shorter.alias("gram")).distinct(), "runs")
    lower = settle(probabilities(needed, model, k - 1), "scores")
    model.settled.extend([needed, lower])
    joined = (
        grams.select("gram", F.substring("gram", 1, k - 1).alias("context"), shorter.alias("shorter"))
        .join(model.weights[k - 1], "gram", "left")
        .join(model.rests[k - 2], "context", "left")
        .join(lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter")
    )
    return joined.select("gram", (F.coalesce("alpha", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("below")).alias("p"))


class _Lookup:
    """Hash table from a run's hash to its log-probability, probed by array operations. Hashes come sorted."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(4, int(4 * len(keys) // 3 + 1).bit_length()))
        # The first bits of a hash are its place; in sorted order a run takes that or the next one that is free.
        place = (keys >> self.shift).astype(np.int64)
        step = np.arange(len(keys))
        place -= step
        np.maximum.accumulate(place, out=place)
        place += step
        size = max(1 << (64 - int(self.shift)), int(place[-1]) + 1 if len(place) else 0) + 1
        # A run's hash is never 0 in practice; an empty place answers 0, and the last one is always empty.
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, np.float32)
        self.keys[place], self.values[place] = keys, values

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        place = (keys >> self.shift).astype(np.int64)
        found = self.keys[place]
        out = np.where(found == keys, self.values[place], np.float32(0))
        left = np.flatnonzero((found != keys) & (found != 0))
        while len(left):
            place[left] += 1
            found = self.keys[place[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[place[left[hit]]]
            left = left[~hit & (found != 0)]
        return out


def _shards(scores: DataFrame, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The scored runs as (hashes, log-probabilities), in pieces of bounded size, one after the other."""
    order = p.order

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer("".join(batch.column("gram").to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, order)
            out = np.zeros(len(codes), np.uint64)
            for k in range(order):
                out = out * _BASE + codes[:, k]
            logs = np.log(batch.column("p").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(mix(out).view(np.int64)), pa.array(logs, pa.float32())], names=["key", "score"])

    named = scores.mapInArrow(name, "key long, score float")
    parts = -(-scores.count() // p.shard_rows)
    for part in range(parts):
        table = named.where(F.pmod("key", F.lit(parts)) == part).toArrow()
        keys = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        yield keys[order], table.column("score").to_numpy()[order]


def _scored(docs: DataFrame, scores: DataFrame, p: Params) -> DataFrame:
    """All rows and columns with ``log_likelihood`` and ``characters``; every shard of the scores adds what it knows."""
    order = p.order
    docs = docs.withColumns({"text": F.col("text").cast("string"), "log_likelihood": F.lit(0.0), "characters": F.lit(0).cast("long")})
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns
    at, count = names.index("log_likelihood"), names.index("characters")

    def add(shards: list[tuple[np.ndarray, np.ndarray]]):  # noqa: ANN202
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookups = [_Lookup(*s) for s in shards]
            for part in slices(batches, "text", SMALL_SLICE_BYTES):
                codes, offsets = _codes(part.column("text").to_pylist(), order)
                ok = _inside(codes, offsets, order)
                hashes = _hashes(codes, order)
                known = np.zeros(len(ok), np.float32)
                for lookup in lookups:  # a run is in one shard at most
                    known += lookup(hashes)
                total = np.zeros(len(ok) + 1)
                np.cumsum(np.where(ok, known, 0), out=total[1:])
                ends = np.minimum(offsets, len(ok))
                sums = total[ends[1:]] - total[ends[:-1]]
                columns = list(part.columns)
                columns[at] = pa.array(part.column(at).to_numpy() + sums)
                columns[count] = pa.array(np.maximum(0, np.diff(offsets) - (order - 1)), pa.int64())
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return run

    held: list[tuple[np.ndarray, np.ndarray]] = []
    passed = False
    for shard in _shards(scores, p):
        if len(held) == p.shards_per_pass:
            docs, held, passed = settle(docs.mapInArrow(add(held), fields), "scored"), [], True
        held.append(shard)
    return docs.mapInArrow(add(held), fields) if held or not passed else docs


def assess(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> DataFrame:
    """All rows and columns of documents (doc_id, text, lang) with perplexity, perplexity_limit and accepted.

    Trusted are documents that labels (doc_id, quality, toxic) call good and not
    toxic. ``perplexity`` is per character of the whole text, start included; a null
    or empty text has none and is accepted. Limits are set per language; a
    language without held-out trusted text (null is a language too) has the limit of all
    languages together, and without any trusted text nothing is rejected. Repeated rows
    and labels change nothing but counts. Input columns with the new names are replaced.

    Every count covers all trusted text and every distinct run of all documents is
    scored by joins on runs. The scored runs come to the tasks in shards of bounded
    size, each of which adds its part of the log-likelihood; texts are never shuffled.
    """
    p = params or Params()
    docs = docs.drop("log_likelihood", "characters", "perplexity", "perplexity_limit", "accepted")
    good = bounded(labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct(), p.broadcast_ids)
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(5)), F.lit(p.hold_out)) == 0
    model = train(docs.where(~held).join(good, "doc_id", "left_semi"), p.order)
    needed = settle(_grams(docs, p.order).select("gram"), "runs")
    scores = settle(probabilities(needed, model, p.order), "scores")
    model.forget()
    discard(needed)

    # Limits come from a histogram in steps of a thousandth: exact to that step, and bounded in size.
    language = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    loss = F.try_divide(-F.col("log_likelihood"), F.col("characters"))
    sample = _scored(docs.where(held).join(good, "doc_id", "left_semi").select("text", "lang"), scores, p)
    bins = sample.where("characters > 0").select(F.floor(loss * 1000).alias("bin"), F.explode(F.array(language, F.lit(None).cast("string"))).alias("language"))
    counted = bins.groupBy("language", "bin").agg(F.count(F.lit(1)).alias("n"))
    limits = {}
    by_language: dict[str | None, list[tuple[int, int]]] = {}
    for row in counted.collect():
        by_language.setdefault(row["language"], []).append((row["bin"], row["n"]))
    for name, rows in by_language.items():
        bins_, n = np.array(sorted(rows)).T
        share = np.cumsum(n) / n.sum()
        limits[name] = float(bins_[np.searchsorted(share, p.quantile - 1e-9)] + 1) / 1000
    of_all = limits.pop(None, None)
    limit = F.lit(of_all).cast("double")
    if limits:
        pairs = F.create_map(*[F.lit(x) for item in sorted(limits.items()) for x in item])
        limit = F.coalesce(F.element_at(pairs, language), limit)
    full = F.col("characters") > 0
    scored = _scored(docs, scores, p)
    discard(scores)
    return scored.withColumns({
        "perplexity": F.when(full, F.exp(loss)),
        "perplexity_limit": F.exp(limit),
        "accepted": ~F.coalesce(full & (loss > limit), F.lit(False)),
    }).drop("log_likelihood", "characters")
