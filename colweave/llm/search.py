"""Ranked lexical search of all documents for every item, with equal bags of words scored once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colweave.llm.tables import BROADCAST_ROWS, discard, settle
from colweave.llm.text import LOWER, flat, pieces, slices, span_hash, word_spans

# The bytes of a term: digits, letters and everything beyond ASCII.
TERM = np.zeros(256, bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True
NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Params:
    """The ``top`` documents of every item.

    Items are searched in blocks of about ``block_items`` items and ``block_terms`` distinct terms, which is what a
    task holds of them; each block reads all documents. A task scores about ``cells`` pairs of class and item at a
    time. Classes that lead somewhere are broadcast up to ``broadcast_bytes``, else joined by shuffle.
    """

    top: int = 10
    block_items: int = 2_000
    block_terms: int = 200_000
    cells: int = 1_000_000
    broadcast_bytes: int = 32 << 20


class Vocabulary:
    """Distinct terms by number, found by hash and confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms
        self.bytes = np.frombuffer(b"".join(terms) or b"\0", np.uint8)
        self.ends = np.cumsum([len(t) for t in terms]).astype(np.int64)
        self.starts = self.ends - np.array([len(t) for t in terms], np.int64)
        names = span_hash(self.bytes, self.starts, self.ends) if terms else np.zeros(0, np.uint64)
        self.order = np.argsort(names, kind="stable")
        self.names = names[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among the spans, numbers of the terms that stand there)."""
        if not len(self.names) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        names = span_hash(data, starts, ends)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        places, numbers = [], []
        hit = np.flatnonzero(self.names[at] == names)
        at = at[hit]
        while len(hit):  # terms of one hash stand side by side; more than one round needs a collision
            number = self.order[at]
            same = ends[hit] - starts[hit] == self.ends[number] - self.starts[number]
            k, n = hit[same], number[same]
            width = ends[k] - starts[k]
            total = int(width.sum())
            inside = np.arange(total) - np.repeat(np.cumsum(width) - width, width)
            equal = data[np.repeat(starts[k], width) + inside] == self.bytes[np.repeat(self.starts[n], width) + inside]
            right = np.logical_and.reduceat(equal, np.cumsum(width) - width) if total else np.zeros(0, bool)
            places.append(k[right])
            numbers.append(n[right])
            left = np.ones(len(hit), bool)
            left[np.flatnonzero(same)[right]] = False
            left &= at + 1 < len(self.names)
            hit, at = hit[left], at[left] + 1
            again = self.names[at] == names[hit]
            hit, at = hit[again], at[again]
        return np.concatenate(places), np.concatenate(numbers)


def _bags(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, bag) of every row: all its terms counted; its terms of the vocabulary as pairs (number, tf) of uint32."""
    size = max(1, len(vocabulary.terms))
    for part in slices(batches, "text"):
        rows = part.num_rows
        n, keys, counts = np.zeros(rows, np.int64), [], []
        data, offsets = flat(part.column("text"))
        for data, offsets, first in pieces(data, offsets, TERM):
            low = LOWER[data]
            starts, ends, words = word_spans(low, offsets, TERM)
            n[first : first + len(offsets) - 1] += np.diff(words)
            place, number = vocabulary.find(low, starts, ends)
            row = np.searchsorted(words, place, "right") - 1 + first
            key, tf = np.unique(row * size + number, return_counts=True)
            keys.append(key)
            counts.append(tf)
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)
        pairs = np.stack([key % size, tf], 1).astype("<u4")
        cut = np.searchsorted(key // size, np.arange(rows + 1))
        bags = [pairs[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"])


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, tfs, class of each) of all bags of a batch."""
    data, offsets = flat(bags)
    pairs = np.frombuffer(data.tobytes(), "<u4").reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1], np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) // 8)


def _frequencies(bags: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; one row per task and term, combined map-side."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_unpacked(batch.column("bag"))[0], minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in bags.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


class Items:
    """The items of a block by term: which hold it, and how often."""

    def __init__(self, items: list[tuple[int | None, str | None]], vocabulary: Vocabulary):
        at, data, offsets = {t: i for i, t in enumerate(vocabulary.terms)}, [], [0]
        for _, text in items:
            found = np.array([at[t] for t in terms_of(text)], np.int64)
            data.append(found)
            offsets.append(offsets[-1] + len(found))
        item = np.repeat(np.arange(len(items)), np.diff(offsets))
        key, times = np.unique((np.concatenate(data) if data else np.zeros(0, np.int64)) * max(1, len(items)) + item, return_counts=True)
        self.number = len(items)
        self.item, self.times = key % max(1, len(items)), times
        self.cut = np.searchsorted(key // max(1, len(items)), np.arange(len(vocabulary.terms) + 1))

    def scores(self, numbers: np.ndarray, values: np.ndarray, owner: np.ndarray, classes: int) -> np.ndarray:
        """Score (class x item): sums of times x value over the terms that both hold, in 64-bit integers."""
        width = self.cut[numbers + 1] - self.cut[numbers]
        total = int(width.sum())
        place = np.repeat(self.cut[numbers] - (np.cumsum(width) - width), width) + np.arange(total)
        out = np.zeros(classes * self.number, np.int64)
        np.add.at(out, np.repeat(owner * self.number, width) + self.item[place], self.times[place] * np.repeat(values, width))
        return out.reshape(classes, self.number)


def terms_of(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), TERM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends, strict=True)]


def _leading(item: np.ndarray, score: np.ndarray, order: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` of each item: highest score, then smallest order."""
    by = np.lexsort((order, -score, item))
    new = np.append(True, item[by][1:] != item[by][:-1])
    rank = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    return by[rank < top]


def _search(docs: DataFrame, items: list[tuple[int | None, str | None]], p: Params) -> DataFrame:
    """(item_id, rank, doc_id, score) for the items of one block over all documents."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(sorted({t for _, text in items for t in terms_of(text)}))
    bags = settle(docs.mapInArrow(lambda batches: _bags(batches, vocabulary), "doc_id long, n long, bag binary"), "bags")
    total = bags.agg(F.count(F.when(F.col("n") > 0, 1)).alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = _frequencies(bags, len(vocabulary.terms))
    weight = np.floor(1000 * np.log((2.0 * total.texts + 2) / (2.0 * df + 1))).astype(np.int64)
    grid = Items(items, vocabulary)

    # A class is one bag and one m: rows meet by hash, and grouping by the bag itself keeps different bags of one hash apart.
    m = F.expr(f"100 - 75 + (75 * n * {total.texts}L) div {max(1, total.terms)}L").alias("m")
    held = bags.where("octet_length(bag) > 0").select("doc_id", m, F.xxhash64("bag").alias("name"), "bag")
    classes = held.groupBy("name", "m", "bag").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("least"))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, p.cells // max(1, grid.number))
        best = [np.zeros(0, np.int64)] * 3  # item, score, least
        rows: list[tuple[int, int, bytes]] = []  # name, m and bag of what leads so far
        bar = np.zeros(grid.number, np.int64)  # an item's lowest leading score, once it has ``top`` of them
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                numbers, tf, owner = _unpacked(batch.column("bag"))
                m = batch.column("m").to_numpy()
                least = batch.column("least").to_numpy()
                values = weight[numbers] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
                scores = grid.scores(numbers, values, owner, batch.num_rows)
                at, item = np.nonzero((scores >= bar) & (scores > 0))
                every = [np.concatenate(x) for x in zip(best, (item, scores[at, item], least[at]), strict=True)]
                origin = np.concatenate([np.arange(len(rows)), len(rows) + np.arange(len(at))])
                kept = _leading(*every, p.top)
                names, bags = batch.column("name"), batch.column("bag")
                new = {k: (names[int(k)].as_py(), int(m[k]), bags[int(k)].as_py()) for k in np.unique(at[origin[kept][origin[kept] >= len(rows)] - len(rows)])}
                rows = [rows[o] if o < len(rows) else new[at[o - len(rows)]] for o in origin[kept]]
                best = [x[kept] for x in every]
                full = np.bincount(best[0], minlength=grid.number) >= p.top
                lowest = np.full(grid.number, NO_ID)
                np.minimum.at(lowest, best[0], best[1])
                bar = np.where(full, lowest, 0)
        if rows:
            columns = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int32()), pa.array(best[1]), pa.array(best[2]), *columns], names=["item", "score", "least", "name", "m", "bag"])

    scored = classes.mapInArrow(score, "item int, score long, least long, name long, m long, bag binary")
    # Any document among an item's first ten is in one of its first ten classes by (score, smallest doc_id).
    leading = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "least", "name", "m", "bag"))
    leaders = settle(scored.withColumn("place", leading).where(F.col("place") <= p.top).drop("place", "least"), "leaders")
    wanted = leaders.select("name", "m", "bag").distinct()
    small = wanted.agg(F.coalesce(F.sum(F.octet_length("bag") + 16), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    few = small.bytes <= p.broadcast_bytes and small.n <= BROADCAST_ROWS
    found = held.join(F.broadcast(wanted) if few else wanted, ["name", "m", "bag"], "left_semi")
    # Only the first ``top`` of a class can matter, however large it is; each task sends at most as many.
    order = F.coalesce("doc_id", F.lit(NO_ID))
    inside = F.row_number().over(Window.partitionBy("name", "m", "bag").orderBy(order, F.col("doc_id").isNull()))
    members = found.withColumn("place", inside).where(F.col("place") <= p.top).drop("place")
    pairs = leaders.join(members, ["name", "m", "bag"])
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), order, F.col("doc_id").isNull()))
    ranked = pairs.withColumn("rank", rank).where(F.col("rank") <= p.top)
    ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], "item int, item_id long")  # one block
    named = ranked.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    done = settle(named, "ranked")  # at most ``top`` rows an item
    discard(bags, leaders)
    return done


def search(docs: DataFrame, items: DataFrame, params: Params | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the documents (doc_id, text) of highest score above 0 for every item (item_id, text).

    Terms are runs of digits, letters and characters beyond ASCII, of which only A-Z are lower-cased. With N
    documents that have terms, L terms in all of them, n terms in one, df documents that hold a term and tf
    occurrences in one: a term weighs floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is
    25 + (75 n N) div L, and its score sums weight x ((10^9 tf) div (1000 tf + 8 m)) over the item's terms,
    repeats included. Equal scores are ranked by ascending doc_id, a null doc_id last; rows that repeat a doc_id are
    ranked one by one. Null and blank texts have no terms and are never found. Items without terms, or with terms
    that no document holds, give no rows; rows of items that repeat an item_id are searched one by one. An empty
    table gives an empty result. Other columns are not read.
    """
    p = params or Params()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    # Blocks by a hash of the text: copies of an item meet in one block, and a block is what the driver and a task hold.
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // p.block_items), -(-size.bytes // (4 * p.block_terms)))
    block = F.pmod(F.xxhash64("text", F.coalesce("item_id", F.lit(-1))), F.lit(blocks))
    out = None
    for k in range(blocks):
        own = [(r.item_id, r.text) for r in asked.where(block == k).orderBy("item_id", "text").collect()]
        part = _search(docs, own, p)
        out = part if out is None else out.unionByName(part)
    return out
