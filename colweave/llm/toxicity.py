"""Toxicity of a text: a bidirectional gated recurrent network with attention over words and their characters, on all overlapping windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.tables import bounded, discard, settle
from colweave.llm.text import LOWER, SLICE_BYTES, flat, mix, slices, span_hash, word_spans

# The bytes of a word: digits, letters and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Params:
    """The network reads windows of ``window`` words, one every ``stride`` words.

    A word enters as the evidence of its hash (``word_bits``) and of its runs of ``shortest`` to ``longest`` bytes
    (``char_bits``), both counted over all labelled rows, and as learned vectors of ``depth`` numbers for either
    (2^``vector_bits`` of them). Words longer than ``word_bytes`` count as several. ``hidden`` is the state's width.

    ``sample_rows`` is the documented bound on the labelled rows that the network is fitted on: about as many, drawn
    by a hash of doc_id, at most three times as many of label 0 as of label 1. One in ``calibrate`` labelled rows is
    left out of that to turn scores into probabilities. ``learners`` run side by side, ``batch`` documents a step,
    and are averaged after each of ``rounds`` passes. ``threshold`` is where a text counts as toxic.
    """

    window: int = 40
    stride: int = 24
    word_bits: int = 17
    char_bits: int = 18
    vector_bits: int = 13
    shortest: int = 3
    longest: int = 5
    word_bytes: int = 40
    depth: int = 8
    hidden: int = 12
    prior: float = 10.0
    sample_rows: int = 12_000
    calibrate: int = 10
    learners: int = 6
    rounds: int = 4
    batch: int = 32
    rate: float = 0.01
    threshold: float = 0.7


class Words:
    """The distinct words of some texts, and which word stands where."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, p: Params):
        low = LOWER[data]
        starts, ends, first = word_spans(low, offsets, WORD)
        width = ends - starts
        if len(width) and width.max() > p.word_bytes:  # a longer word counts as several
            times = -(-width // p.word_bytes)
            inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            starts = np.repeat(starts, times) + inside * p.word_bytes
            ends = np.minimum(starts + p.word_bytes, np.repeat(ends, times))
            first = np.append(0, np.cumsum(times))[first]
        self.first = first  # first word of every text
        names = span_hash(low, starts, ends)
        self.names, at, self.word = np.unique(names, return_index=True, return_inverse=True)
        self.buckets = (self.names >> np.uint64(64 - p.word_bits)).astype(np.int64)
        self._runs(low, starts[at], ends[at], p)

    def _runs(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: Params) -> None:
        """Buckets of the character runs of every distinct word, with a mark at both ends."""
        width = ends - starts + 2
        total = int(width.sum())
        shift = np.cumsum(width) - width
        place = np.arange(total) - np.repeat(shift, width)
        code = np.full(total, 1, np.uint64)  # the mark
        real = (place > 0) & (place < np.repeat(width, width) - 1)
        code[real] = low[(np.repeat(starts, width) + place - 1)[real]].astype(np.uint64) + np.uint64(2)
        left = np.repeat(width, width) - place
        run, kept, owners = code.copy(), [], []
        owner = np.repeat(np.arange(len(starts)), width)
        for size in range(2, p.longest + 1):
            run = run[:-1] * np.uint64(1_000_003) + code[size - 1 :] if len(run) > 1 else run[:0]
            if size >= p.shortest:
                whole = left[: len(run)] >= size
                kept.append(mix(run[whole] * np.uint64(2 * p.longest) + np.uint64(size)) >> np.uint64(64 - p.char_bits))
                owners.append(owner[: len(run)][whole])
        runs, owner = np.concatenate(kept).astype(np.int64), np.concatenate(owners)
        by = np.argsort(owner, kind="stable")
        self.runs = runs[by]
        # A word of one byte has a run of three: the byte between its marks.
        self.cut = np.searchsorted(owner[by], np.arange(len(starts) + 1))


def _evidence(held: np.ndarray, total: np.ndarray, p: Params) -> np.ndarray:
    """Log-odds of label 1 for features that ``held`` (label, feature) documents hold, drawn to 0 where few do."""
    share = (total[1] + 1) / (total.sum() + 2)
    rate = (held[1] + p.prior * share) / (held.sum(0) + p.prior)
    return (np.log(rate / (1 - rate)) - np.log(share / (1 - share))).astype(np.float32)


@dataclass
class Evidence:
    """Log-odds by word and by character run."""

    word: np.ndarray
    run: np.ndarray


def _inputs(words: Words, evidence: Evidence, w: Weights, p: Params) -> np.ndarray:
    """Input (distinct word x number): evidence of the word, largest and mean of its runs, and both learned vectors."""
    mask = (1 << p.vector_bits) - 1
    n = len(words.names)
    if not n:
        return np.zeros((0, 3 + 2 * p.depth), np.float32)
    odds = evidence.run[words.runs]
    size = np.diff(words.cut).astype(np.float32)
    mean = lambda x: np.add.reduceat(x, words.cut[:-1]) / (size if x.ndim == 1 else size[:, None])
    return np.concatenate([
        evidence.word[words.buckets][:, None], np.maximum.reduceat(odds, words.cut[:-1])[:, None], mean(odds)[:, None],
        w["words"][words.buckets & mask], mean(w["runs"][words.runs & mask]),
    ], 1)


def first_weights(p: Params) -> Weights:
    rng = np.random.default_rng(5)
    width, h = 3 + 2 * p.depth, p.hidden
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    out = {
        "words": 0.1 * draw(1 << p.vector_bits, p.depth) * np.sqrt(1 << p.vector_bits), "runs": 0.1 * draw(1 << p.vector_bits, p.depth) * np.sqrt(1 << p.vector_bits),
        "look": draw(2 * h, h), "look0": np.zeros(h), "pick": draw(h, 1)[:, 0], "out": draw(2 * h, 1)[:, 0], "out0": np.full(1, -1.0),
    }
    for way in "fb":
        out |= {f"in_{way}": draw(width, 3 * h), f"in0_{way}": np.zeros(3 * h), f"gate_{way}": draw(h, 2 * h), f"new_{way}": draw(h, h)}
    return {k: v.astype(np.float32) for k, v in out.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(way: str, projected: np.ndarray, real: np.ndarray, w: Weights, keep: list | None = None) -> np.ndarray:
    """States (window x place x hidden) of one direction; ``projected`` are the inputs' shares of gates and candidates."""
    n, length, h = len(projected), projected.shape[1], w[f"new_{way}"].shape[0]
    state, out = np.zeros((n, h), np.float32), np.zeros((n, length, h), np.float32)
    for t in range(length) if way == "f" else reversed(range(length)):
        x = projected[:, t]
        gates = _sigmoid(x[:, : 2 * h] + state @ w[f"gate_{way}"])
        update, reset = gates[:, :h], gates[:, h:]
        new = np.tanh(x[:, 2 * h :] + (reset * state) @ w[f"new_{way}"])
        after = np.where(real[:, t, None], state + update * (new - state), state)
        if keep is not None:
            keep.append((t, state, update, reset, new))
        out[:, t] = state = after
    return out


def forward(x: dict[str, np.ndarray], real: np.ndarray, w: Weights, keep: dict | None = None) -> np.ndarray:
    """Logit of every window; ``x`` holds the projected inputs (window x place x 3 hidden) per direction."""
    steps = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
    states = np.concatenate([_read(way, x[way], real, w, steps[way]) for way in "fb"], 2)
    looked = np.tanh(states @ w["look"] + w["look0"])
    weight = np.where(real, looked @ w["pick"], -1e9)
    weight = np.exp(weight - weight.max(1, keepdims=True)) * real
    weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
    pooled = (weight[:, None, :] @ states)[:, 0]
    if keep is not None:
        keep |= {"steps": steps, "states": states, "looked": looked, "weight": weight, "pooled": pooled}
    return pooled @ w["out"] + w["out0"][0]


def backward(inputs: np.ndarray, real: np.ndarray, w: Weights, kept: dict, slope: np.ndarray) -> tuple[Weights, np.ndarray]:
    """(gradients of the weights, gradient of the inputs) for the slope of the loss by each window's logit."""
    g: Weights = {"out": kept["pooled"].T @ slope, "out0": slope.sum(keepdims=True)}
    d_pooled = slope[:, None] * w["out"]
    weight, states, looked = kept["weight"], kept["states"], kept["looked"]
    d_states = weight[:, :, None] * d_pooled[:, None]
    d_weight = (states @ d_pooled[:, :, None])[:, :, 0]
    d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    g["pick"] = np.einsum("nt,nth->h", d_score, looked)
    d_look = d_score[:, :, None] * w["pick"] * (1 - looked * looked)
    g["look"], g["look0"] = np.einsum("nti,nth->ih", states, d_look), d_look.sum((0, 1))
    d_states = d_states + d_look @ w["look"].T
    h, d_inputs = w["new_f"].shape[0], np.zeros_like(inputs)
    for way, own in (("f", d_states[:, :, :h]), ("b", d_states[:, :, h:])):
        d_x = np.zeros((*real.shape, 3 * h), np.float32)
        gate, new_w = np.zeros_like(w[f"gate_{way}"]), np.zeros_like(w[f"new_{way}"])
        carried = np.zeros((len(real), h), np.float32)
        for t, state, update, reset, new in reversed(kept["steps"][way]):
            live = real[:, t, None]
            d = carried + own[:, t]
            d_after = np.where(live, d, 0)
            d_new = d_after * update * (1 - new * new)
            d_reset = (d_new @ w[f"new_{way}"].T) * state
            d_gates = np.concatenate([d_after * (new - state) * update * (1 - update), d_reset * reset * (1 - reset)], 1)
            d_x[:, t] = np.concatenate([d_gates, d_new], 1)
            gate += state.T @ d_gates
            new_w += (reset * state).T @ d_new
            before = d_after * (1 - update) + (d_new @ w[f"new_{way}"].T) * reset + d_gates @ w[f"gate_{way}"].T
            carried = np.where(live, before, d)
        g |= {f"gate_{way}": gate, f"new_{way}": new_w, f"in_{way}": np.einsum("nti,nth->ih", inputs, d_x), f"in0_{way}": d_x.sum((0, 1))}
        d_inputs += d_x @ w[f"in_{way}"].T
    return g, d_inputs


def _windows(first: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text) of every window: one each ``stride`` words until the last word is in one; none without words."""
    counts = np.diff(first)
    many = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - p.window) // p.stride)), 0)
    text = np.repeat(np.arange(len(counts)), many)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return first[text] + inside * p.stride, text


def _logits(words: Words, evidence: Evidence, w: Weights, p: Params, chunk: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logit, first word, text) of all windows."""
    start, text = _windows(words.first, p)
    inputs = _inputs(words, evidence, w, p)
    projected = {way: inputs @ w[f"in_{way}"] + w[f"in0_{way}"] for way in "fb"}
    out, end = np.zeros(len(start), np.float32), words.first[1:][text]
    for k in range(0, len(start), chunk):
        place = start[k : k + chunk, None] + np.arange(p.window)
        real = place < end[k : k + chunk, None]
        at = words.word[np.where(real, place, start[k : k + chunk, None])]
        out[k : k + chunk] = forward({way: projected[way][at] for way in "fb"}, real, w)
    return out, start, text


def _spread(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of parts: all texts, or overlapping stretches of one long text, cut between words where there is a gap."""
    if len(data) <= 2 * SLICE_BYTES or len(offsets) > 2:
        yield data, offsets
        return
    at, overlap = 0, 4096
    while True:
        stop = min(len(data), at + SLICE_BYTES)
        gaps = np.flatnonzero(~WORD[data[stop - overlap : stop]]) + stop - overlap
        end = stop if stop == len(data) or not len(gaps) else int(gaps[-1])
        yield data[at:end], np.array([0, end - at], np.int64)
        if stop == len(data):
            return
        at = int(gaps[0]) if len(gaps) else end


def _best(batches: Iterable[pa.RecordBatch], evidence: Evidence, w: Weights, p: Params) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches, and the highest logit among each text's windows (the lowest number for a text without words)."""
    for part in slices(batches, "text"):
        best = np.full(part.num_rows, -np.inf)
        for data, offsets in _spread(*flat(part.column("text"))):
            logit, _, text = _logits(Words(data, offsets, p), evidence, w, p)
            np.maximum.at(best, text, logit)
        yield part, best


def _counted(labelled: DataFrame, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(documents by half and label, documents that hold each feature by half and label) over all labelled rows.

    Runs and words share one vector of features. Every task adds up its rows; what is shuffled is bounded by the features.
    """
    features = (1 << p.word_bits) + (1 << p.char_bits)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, features + 1), np.int64)
        for part in slices(batches, "text"):
            kind = part.column("half").to_numpy() * 2 + part.column("toxic").to_numpy()
            for data, offsets in _spread(*flat(part.column("text"))):
                words = Words(data, offsets, p)
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
                pair = np.unique(text * max(1, len(words.names)) + words.word)
                owner, word = pair // max(1, len(words.names)), pair % max(1, len(words.names))
                size = np.diff(words.cut)[word]
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                runs = words.runs[np.repeat(words.cut[:-1][word], size) + inside]
                found = np.unique(np.concatenate([
                    owner * features + words.buckets[word], np.repeat(owner, size) * features + (1 << p.word_bits) + runs,
                ]))
                np.add.at(held, (kind[found // features], found % features), 1)
            held[:, features] += np.bincount(kind, minlength=4)
        which, at = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(which * (features + 1) + at), pa.array(held[which, at])], names=["feature", "n"])

    sums = labelled.select("text", "toxic", "half").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(4 * (features + 1), np.int64)
    held[sums.column("feature").to_numpy()] = sums.column("n").to_numpy()
    held = held.reshape(2, 2, features + 1)
    return held[:, :, features], held[:, :, :features]


def _weighed(total: np.ndarray, held: np.ndarray, p: Params) -> Evidence:
    odds = _evidence(held, total, p)
    return Evidence(odds[: 1 << p.word_bits], odds[1 << p.word_bits :])


class Adam:
    """Steps scaled by running moments; rows of the learned vectors are moved only where they were read."""

    def __init__(self, w: Weights, rate: float):
        self.w, self.rate, self.t = w, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in w.items()}
        self.v = {k: np.zeros_like(v) for k, v in w.items()}

    def step(self, g: Weights, rows: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, own in g.items():
            at = rows.get(k, slice(None))
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * own
            self.v[k][at] = 0.99 * self.v[k][at] + 0.01 * own * own
            self.w[k][at] -= self.rate * (self.m[k][at] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k][at] / (1 - 0.99**self.t)) + 1e-6)


def _learn(texts: list[str | None], label: np.ndarray, evidence: Evidence, adam: Adam, p: Params) -> None:
    """One step on some documents: the window that speaks most for label 1 stands for its document."""
    w = adam.w
    words = Words(*flat(pa.array(texts, pa.string())), p)
    logit, start, text = _logits(words, evidence, w, p)
    order = np.lexsort((start, -logit, text))
    lead = order[np.append(True, text[order][1:] != text[order][:-1])] if len(order) else order
    if not len(lead):
        return
    start, text = start[lead], text[lead]
    place = start[:, None] + np.arange(p.window)
    real = place < words.first[1:][text][:, None]
    at = words.word[np.where(real, place, start[:, None])]
    inputs = _inputs(words, evidence, w, p)
    seen, kept = inputs[at], {}
    z = forward({way: seen @ w[f"in_{way}"] + w[f"in0_{way}"] for way in "fb"}, real, w, kept)
    g, d_inputs = backward(seen, real, w, kept, ((_sigmoid(z) - label[text]) / len(z)).astype(np.float32))
    d_word = np.zeros_like(inputs)
    np.add.at(d_word, at[real], d_inputs[real])
    used = np.unique(at[real])
    mask, size = (1 << p.vector_bits) - 1, np.diff(words.cut)
    rows, rows_at = np.unique(words.buckets[used] & mask, return_inverse=True)
    g["words"] = np.zeros((len(rows), p.depth), np.float32)
    np.add.at(g["words"], rows_at, d_word[used, 3 : 3 + p.depth])
    inside = np.arange(size[used].sum()) - np.repeat(np.cumsum(size[used]) - size[used], size[used])
    runs, runs_at = np.unique(words.runs[np.repeat(words.cut[:-1][used], size[used]) + inside] & mask, return_inverse=True)
    g["runs"] = np.zeros((len(runs), p.depth), np.float32)
    np.add.at(g["runs"], runs_at, np.repeat(d_word[used, 3 + p.depth :] / size[used][:, None], size[used], 0))
    adam.step(g, {"words": rows, "runs": runs})


def _fit(sample: DataFrame, halves: list[Evidence], p: Params) -> Weights:
    """Weights after all rounds; each learner works through its share of the sample, then all are averaged."""
    w = first_weights(p)
    names = sorted(w)

    def learner(w: Weights):  # noqa: ANN202
        def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            adam, held, done = Adam({k: v.copy() for k, v in w.items()}, p.rate), [], False
            for batch in batches:
                held += zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half")), strict=True)
                while len(held) >= p.batch:
                    _halves(held[: p.batch], adam)
                    held, done = held[p.batch :], True
            if held:
                _halves(held, adam)
            if held or done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(names)), pa.int32()), pa.array([adam.w[k].astype(np.float32).tobytes() for k in names], pa.binary())], names=["which", "values"]
                )

        def _halves(rows: list[tuple], adam: Adam) -> None:
            for half in (0, 1):  # a row's evidence comes from the rows of the other half
                own = [r for r in rows if r[2] == half]
                if own:
                    _learn([r[0] for r in own], np.array([r[1] for r in own], np.float32), halves[1 - half], adam, p)

        return learn

    for _ in range(p.rounds):
        found = sample.mapInArrow(learner(w), "which int, values binary").collect()  # one set of weights per learner
        if not found:
            break
        w = {
            k: np.mean([np.frombuffer(r["values"], np.float32) for r in found if r.which == i], 0, dtype=np.float32).reshape(w[k].shape)
            for i, k in enumerate(names)
        }
    return w


def _scaled(calibration: DataFrame, evidence: Evidence, w: Weights, p: Params) -> tuple[float, float]:
    """(slope, shift) of the logistic curve from logits to labels, fitted on a histogram of logits over the rows left out."""
    edge, bins = 20.0, 800

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, bins), np.int64)
        for part, best in _best(batches, evidence, w, p):
            at = np.clip((best + edge) / (2 * edge) * bins, 0, bins - 1).astype(np.int64)
            words = np.isfinite(best)
            np.add.at(n, (part.column("toxic").to_numpy()[words], at[words]), 1)
        label, at = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(label * bins + at), pa.array(n[label, at])], names=["place", "n"])

    n = np.zeros(2 * bins)
    for r in calibration.mapInArrow(measure, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        n[r.place] = r.n
    n = n.reshape(2, bins)
    if not n.sum(1).all():
        return 1.0, 0.0
    x = (np.arange(bins) + 0.5) / bins * 2 * edge - edge
    # Labels drawn in by one pseudo row each, so that separable rows have a finite curve.
    high, low = (n[1].sum() + 1) / (n[1].sum() + 2), 1 / (n[0].sum() + 2)
    goal, total = n[1] * high + n[0] * low, n.sum(0)
    a, b = 1.0, 0.0
    loss = lambda a, b: float((total * np.logaddexp(0, a * x + b) - goal * (a * x + b)).sum())
    for _ in range(100):
        q = _sigmoid(a * x + b)
        slope = np.array([((total * q - goal) * x).sum(), (total * q - goal).sum()])
        v = total * q * (1 - q)
        curve = np.array([[(v * x * x).sum(), (v * x).sum()], [(v * x).sum(), v.sum()]]) + 1e-6 * np.eye(2)
        move, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(a - size * move[0], b - size * move[1]) > loss(a, b):
            size /= 2
        a, b = a - size * move[0], b - size * move[1]
        if np.abs(size * move).max() < 1e-7:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def score(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of documents (doc_id, text), learned from labels (doc_id, toxic).

    Learns from documents whose crc32(doc_id as text) mod 3 is not 1 (``held_out``; a row without doc_id is held out
    too) and that have a label: the largest toxic of the doc_id's rows in ``labels``, other values than 0 and 1 aside.
    A score rests on the text alone: all windows of the whole text are read, the highest logit counts, and a
    logistic curve makes it the chance of label 1. A text without words (null, empty, blank) scores 0, and without
    labels of both kinds every text does. A text of over 4 MB is read in stretches of 2 MB that overlap by 4 KB.
    Rows that repeat a doc_id are scored one by one. An empty table gives an empty result. Other columns are not read.
    """
    p = params or Params()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held.alias("held_out"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lot = lambda seed, n: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(n))
    met = rows.where("not held_out").join(bounded(known), "doc_id")
    labelled = settle(met.select("doc_id", "text", "toxic", lot(7, 2).cast("int").alias("half")), "labelled")
    total, counts = _counted(labelled, p)
    able = bool(total.sum(0).all())
    if able:
        halves = [_weighed(total[k], counts[k], p) for k in (0, 1)]
        evidence = _weighed(total.sum(0), counts.sum(0), p)
        apart = lot(23, p.calibrate) == 0
        few = int(total[:, 1].sum())
        toxic = min(1.0, p.sample_rows / 4 / few)
        clean = min(1.0, min(p.sample_rows, max(3 * few * toxic, p.sample_rows / 8)) / int(total[:, 0].sum()))
        share = F.when(F.col("toxic") == 1, toxic).otherwise(clean) * 1_000_000
        sample = settle(labelled.where(~apart & (lot(11, 1_000_000) < share)), "sample")
        # One share per learner; the order inside is fixed, so a lost learner learns the same again.
        dealt = sample.repartition(p.learners, lot(31, p.learners)).sortWithinPartitions(F.xxhash64("doc_id", F.lit(37)), "text")
        w = _fit(dealt.select("text", "toxic", "half"), halves, p)
        discard(sample)
        slope, shift = _scaled(labelled.where(apart).select("text", "toxic"), evidence, w, p)
    discard(labelled)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if able:
            found = ((part, _sigmoid(slope * best.astype(np.float64) + shift)) for part, best in _best(batches, evidence, w, p))
        else:
            found = ((part, np.zeros(part.num_rows)) for part in batches)
        for part, chance in found:
            predicted = (chance >= p.threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(chance), pa.array(predicted)], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
