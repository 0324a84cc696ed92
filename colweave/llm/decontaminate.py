"""Benchmark passages in documents: fingerprints of item-sized windows, verified on weighted shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.text import LOWER, SMALL_SLICE_BYTES, flat, mix, shingles, slices, span_hash, word_spans

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
BITS = 64


@dataclass(frozen=True)
class Params:
    """A window matches an item at ``similarity`` or more on shingles of ``words`` words.

    Fingerprints within ``radius`` bits are candidates; they are found through
    ``radius`` + 1 blocks of bits, one of which must be equal. The benchmark is
    worked through in blocks of ``block_words`` words, so what a task gets is bounded.
    """

    words: int = 5
    similarity: float = 0.8
    radius: int = 16
    block_words: int = 1_000_000


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD)
    return span_hash(low, starts, ends), first


def _member(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, values), max(0, len(table) - 1))
    return at, (table[at] == values if len(table) else np.zeros(len(values), bool))


class Index:
    """Items by size with their fingerprints and shingle bags. Words weigh what their rarity among the items gives."""

    def __init__(self, ids: list[int | None], texts: list[str | None], p: Params) -> None:
        self.p, self.ids = p, ids
        words, first = _word_hashes(pa.array(texts, pa.string()))
        owner = np.repeat(np.arange(len(ids)), np.diff(first))
        once = np.unique(np.stack([words, owner.astype(np.uint64)]), axis=1)[0] if len(words) else words
        self.vocabulary, held = np.unique(once, return_counts=True)
        # Whole weights from 1 to 8 keep running sums exact.
        self.rarity = np.clip(np.round(8 * np.log((len(ids) + 1) / held) / np.log(len(ids) + 2)), 1, 8).astype(np.int32)
        self.sizes = np.diff(first)
        grams, offsets = shingles(words, first, p.words)
        # Whole items that are shorter than a shingle are looked up as runs of their own length.
        self.grams = np.unique(grams)
        self.short = sorted({int(s) for s in self.sizes if 0 < s < p.words})
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        weights = self.weights(words)
        self.bags = []
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        prints = np.zeros(len(ids), np.uint64)
        for k in range(len(ids)):
            a, b = first[k], first[k + 1]
            self.bags.append(self.bag(words[a:b], weights[a:b]))
            if b > a:
                prints[k] = _fingerprints(_signed_sums(words[a:b], weights[a:b]), np.zeros(1, np.int64), b - a)[0]
        # Every shingle with its item, for items that are longer than a document.
        holder = np.repeat(np.arange(len(ids)), np.diff(offsets))
        order = np.argsort(grams, kind="stable")
        self.held, self.holder = grams[order], holder[order]
        self.totals = np.array([bag[1].sum() for bag in self.bags], np.int64)
        size_of = np.repeat(self.sizes, np.diff(offsets))
        self.grams_of: dict[int, np.ndarray] = {}
        for size in np.unique(self.sizes[self.sizes > 0]).tolist():
            items = np.flatnonzero(self.sizes == size)
            self.by_size[size] = items, prints[items]
            self.grams_of[size] = np.unique(grams[size_of == size])

    def weights(self, words: np.ndarray) -> np.ndarray:
        at, known = _member(words, self.vocabulary)
        return np.where(known, self.rarity[at] if len(self.rarity) else 8, 8).astype(np.int32)

    def bag(self, words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct shingles, weight x times) of one passage; a shingle weighs the sum of its words."""
        grams, _ = shingles(words, np.array([0, len(words)]), self.p.words)
        width = min(self.p.words, len(words))
        total = np.concatenate([[0], np.cumsum(weights)])
        weight = total[width:] - total[:-width] if width else total[:0]
        found, at, times = np.unique(grams, return_index=True, return_counts=True)
        return found, weight[at] * times

    def longer(self, grams: np.ndarray, n: int, total: int) -> list[int]:
        """Items of more than ``n`` words that hold one of the shingles and that a bag of weight ``total`` can match."""
        low, high = np.searchsorted(self.held, grams, "left"), np.searchsorted(self.held, grams, "right")
        step = np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        items = np.unique(self.holder[np.repeat(low, high - low) + step])
        return items[(self.sizes[items] > n) & (total >= self.p.similarity * self.totals[items])].tolist()

    def seeds(self, grams: np.ndarray) -> np.ndarray:
        """Places of shingles that some item holds; elsewhere the similarity is 0 and no window is needed."""
        likely = np.flatnonzero(self.filter[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        return likely[_member(grams[likely], self.grams)[1]]


def _signed_sums(words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums, per bit, of the words' weights with the sign of the bit."""
    bits = np.unpackbits(mix(words).view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros((len(words) + 1, BITS), np.int32)
    np.cumsum((bits.astype(np.int32) * 2 - 1) * weights[:, None], axis=0, out=out[1:])
    return out


def _fingerprints(sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return np.packbits(sums[starts + size] > sums[starts], axis=1).view(np.uint64).ravel()


def candidates(windows: np.ndarray, items: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All (window, item) pairs within ``radius`` bits: of radius + 1 blocks of bits at least one is equal."""
    edges = np.linspace(0, BITS, radius + 2).astype(int)
    pairs = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        cut = lambda x: (x >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)  # noqa: B023, E731
        order = np.argsort(cut(items), kind="stable")
        block, mine = cut(items)[order], cut(windows)
        first, stop = np.searchsorted(block, mine, "left"), np.searchsorted(block, mine, "right")
        many = stop - first
        window = np.repeat(np.arange(len(windows)), many)
        step = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
        item = order[first[window] + step]
        near = np.bitwise_count(windows[window] ^ items[item]) <= radius
        pairs.append(window[near] * len(items) + item[near])
    found = np.unique(np.concatenate(pairs))
    return found // len(items), found % len(items)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones."""
    common, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][x], b[1][y]).sum() if len(common) else 0
    return float(both / max(1, a[1].sum() + b[1].sum() - both))


def _matches(words: np.ndarray, index: Index) -> list[tuple[int, float, int]]:
    """(item, similarity, first word) of the best window of every item found in one text."""
    p, n = index.p, len(words)
    runs = {w: shingles(words, np.array([0, n]), w)[0] for w in {*index.short, p.words} if w <= n}
    seeds_of = {w: index.seeds(grams) for w, grams in runs.items()}
    weights = index.weights(words)
    sums = _signed_sums(words, weights)
    best: dict[int, tuple[float, int]] = {}
    for size, (items, prints) in index.by_size.items():
        if size > n:
            continue
        # Windows of this size that hold at least one shingle of an item of this size.
        width = min(p.words, size)
        seeds = seeds_of[width]
        seeds = seeds[_member(runs[width][seeds], index.grams_of[size])[1]]
        if not len(seeds):
            continue
        opened = np.zeros(n + 1, np.int32)
        np.add.at(opened, np.maximum(0, seeds + width - size), 1)
        np.add.at(opened, np.minimum(seeds, n - size) + 1, -1)
        starts = np.flatnonzero(np.cumsum(opened[: n - size + 1]) > 0)
        if not len(starts):
            continue
        window, item = candidates(_fingerprints(sums, starts, size), prints, p.radius)
        for w, k in zip(starts[window].tolist(), items[item].tolist(), strict=True):
            found = similarity(index.bag(words[w : w + size], weights[w : w + size]), index.bags[k])
            if found >= p.similarity and found > best.get(k, (0.0, 0))[0]:
                best[k] = found, w
    if len(seeds_of.get(p.words, ())) and n < index.sizes.max():
        # Items that are longer than the text meet all of it.
        whole = index.bag(words, weights)
        for k in index.longer(np.unique(runs[p.words][seeds_of[p.words]]), n, int(whole[1].sum())):
            found = similarity(whole, index.bags[k])
            if found >= p.similarity:
                best[k] = found, 0
    return [(k, *best[k]) for k in sorted(best)]


def _blocks(benchmark: DataFrame, p: Params) -> Iterator[Index]:
    """The benchmark in blocks of bounded size, in the order of its rows on disk; each is one pass over the documents."""
    ids, texts, held = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        held += len((row.text or "").split())
        if held >= p.block_words:
            yield Index(ids, texts, p)
            ids, texts, held = [], [], 0
    if ids:
        yield Index(ids, texts, p)


def mark(docs: DataFrame, benchmark: DataFrame, params: Params | None = None) -> DataFrame:
    """All rows and columns of documents (text) with ``contaminated_by``: (item_id, similarity, start, words) of every
    benchmark item (item_id, text) found.

    Words are runs of a-z, 0-9 and non-ASCII after lower-casing A-Z. A window has
    as many words as the item, or is the whole text if that has fewer; ``start`` counts words from 0. An item
    shorter than a shingle matches as a whole. Null, empty and wordless texts and items match
    nothing; repeated items are all reported. An input column called
    contaminated_by is replaced. Texts are read whole, whatever their length.

    A window without any shingle of the benchmark has similarity 0, so only the
    others get a fingerprint; nothing is shuffled, and a task holds one block
    of the benchmark and one slice of texts.
    """
    p = params or Params()
    kind = "array<struct<item_id: bigint, similarity: double, start: bigint, words: bigint>>"
    docs = docs.drop("contaminated_by").withColumns(
        {"text": F.col("text").cast("string"), "contaminated_by": F.array().cast(kind)}
    )
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    place = docs.columns.index("contaminated_by")
    struct = pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()), ("words", pa.int64())])

    def look(index: Index):  # noqa: ANN202
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text", SMALL_SLICE_BYTES):
                words, first = _word_hashes(part.column("text"))
                found = part.column("contaminated_by").to_pylist()
                hit = set()
                for width in (*index.short, p.words):
                    grams, offsets = shingles(words, first, width)
                    hit.update((np.searchsorted(offsets, index.seeds(grams), "right") - 1).tolist())
                for d in sorted(hit):
                    a, b = first[d], first[d + 1]
                    for k, score, start in _matches(words[a:b], index):
                        found[d].append({"item_id": index.ids[k], "similarity": score, "start": start, "words": int(min(index.sizes[k], b - a))})
                columns = list(part.columns)
                columns[place] = pa.array(found, pa.list_(struct))
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

        return run

    for index in _blocks(benchmark, p):
        docs = docs.mapInArrow(look(index), fields)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: Params | None = None) -> DataFrame:
    """The documents that hold no benchmark passage, with their columns as they are; see ``mark``."""
    return mark(docs, benchmark, params).where(F.size("contaminated_by") == 0).drop("contaminated_by")
