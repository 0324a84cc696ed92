"""Repeated passages: winnowed fingerprints of words, joined positions, runs extended both ways."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.tables import bounded, discard, salted_join, settle, settle_by, unused
from colweave.llm.text import LOWER, NOT_SPACE, SMALL_SLICE_BYTES, SPACE, flat, mix, ragged, slices, span_hash, word_spans

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SHARD_GRAMS = 1 << 20
_PACK_GRAMS = 1 << 22


@dataclass(frozen=True)
class Params:
    """Runs of under ``least_words`` words are never deleted; every repeated run of ``sure_words`` or more is.

    Runs begin and end at any word, also inside a line. What a run holds beside its outermost fingerprints
    is compared for up to ``reach`` words either way; more than ``sure_words`` words would hold another fingerprint.
    """

    least_words: int = 40
    sure_words: int = 50
    reach: int = 50


def _ends(words: np.ndarray, least: int) -> np.ndarray:
    """For every start the end of the shortest run of ``least`` words, or one past the last unit + 1."""
    total = np.concatenate([[0], np.cumsum(words)])
    return np.searchsorted(total, total[:-1] + least)


def _smallest(value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the smallest of value[low:high], the last of equals, for every pair."""
    best = [np.arange(len(value))]
    while len(low) and (1 << len(best)) <= int((high - low).max()):
        half = 1 << (len(best) - 1)
        a, b = best[-1][:-half], best[-1][half:]
        best.append(np.where(value[b] <= value[a], b, a))
    level = np.frexp((high - low).astype(float))[1] - 1
    out = np.zeros(len(low), np.int64)
    for k, places in enumerate(best):
        at = np.flatnonzero(level == k)
        a, b = places[low[at]], places[high[at] - (1 << k)]
        out[at] = np.where(value[b] <= value[a], b, a)
    return out


def _choose(hashes: np.ndarray, words: np.ndarray, first: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, first units, end units) of texts that stand one after the other, text k from unit first[k] on."""
    n = len(hashes)
    gram_end, window_end = _ends(words, p.least_words), _ends(words, p.sure_words)
    total = np.zeros(n + 1, np.uint64)
    power, inverse = np.full((2, n + 1), 1, np.uint64)
    power[1:] = np.cumprod(np.full(n, _BASE), dtype=np.uint64)
    # A run's hash must not depend on where it stands: divide by the power of its first unit.
    inverse[1:] = np.cumprod(np.full(n, _INVERSE), dtype=np.uint64)
    total[1:] = np.cumsum(hashes.view(np.uint64) * power[:n], dtype=np.uint64)
    whole = np.flatnonzero(gram_end <= n)
    value = mix((total[gram_end[whole]] - total[whole]) * inverse[whole])
    # Grams end in the order they start, so those inside a window are consecutive.
    start = np.flatnonzero(window_end <= np.repeat(first[1:], np.diff(first)))
    low = np.searchsorted(whole, start)
    high = np.searchsorted(gram_end[whole], window_end[start], "right")
    chosen = np.unique(_smallest(value, low, high))
    return value[chosen].view(np.int64), whole[chosen], gram_end[whole[chosen]]


def winnow(hashes: np.ndarray, words: np.ndarray, p: Params) -> list[tuple[int, int, int]]:
    """(fingerprint, first unit, end unit) of the chosen runs of one text of units of so many words.

    A gram is the shortest run of ``least_words`` words from a unit on; a window
    is the shortest of ``sure_words``. Every window gives the smallest of the
    grams inside it (the last of equals), so two texts that share a window share a fingerprint.
    """
    found = _choose(hashes, words, np.array([0, len(hashes)]), p)
    return list(zip(*(column.tolist() for column in found), strict=True))


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the words that are left, first word per text, words that follow a cut)."""
    data, offsets = flat(part.column("text"))
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_SPACE)
    hashes = span_hash(low, starts, ends)
    lengths = part.column("starts").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if not lengths.any():
        return hashes, first, np.zeros(0, np.int64)
    base = np.repeat(first[:-1], lengths)
    begin, stop = (base + part.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("starts", "stops"))
    depth = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, stop, -1)
    left = np.cumsum(depth[:-1]) == 0
    number = np.concatenate([[0], np.cumsum(left)])
    return hashes[left], number[first], number[begin]


def _fingerprints(texts: DataFrame, p: Params) -> DataFrame:
    """(gram, doc_id, doc, first, fresh): chosen runs by their first word; fresh are those beside a cut."""

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SMALL_SLICE_BYTES):
            hashes, first, cuts = _words(part)
            gram, begin, _ = _choose(hashes, np.ones(len(hashes), np.int64), first, p)
            row = np.searchsorted(first, begin, "right") - 1
            # A window over a cut is new, and so may be its choice.
            fresh = np.searchsorted(cuts, begin - p.sure_words) < np.searchsorted(cuts, begin + p.sure_words, "right")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram, pa.int64()), part.column("doc_id").take(pa.array(row)), part.column("doc").take(pa.array(row)),
                    pa.array(begin - first[row], pa.int32()), pa.array(fresh, pa.bool_()),
                ],
                names=["gram", "doc_id", "doc", "first", "fresh"],
            )

    return texts.mapInArrow(choose, "gram long, doc_id long, doc long, first int, fresh boolean")


def _repeated(grams: DataFrame) -> DataFrame:
    """(gram): those of a settled table that stand in more than one row.

    Every task packs its distinct grams by shard, so that a gram travels at most twice from a task's block and as eight
    bytes; a shard merges sorted blocks, and holds each of its grams once, however often it stands.
    """
    parts = -(-grams.count() // _SHARD_GRAMS) or 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[np.ndarray]) -> pa.RecordBatch:
            found, many = np.unique(np.concatenate(held), return_counts=True)
            found = np.concatenate([found, found[many > 1]])
            shard = (found.view(np.uint64) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            found, numbers = found[order], np.unique(shard)
            ends = np.searchsorted(shard[order], numbers, "right")
            rows = [found[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(rows, pa.binary())], names=["shard", "block"])

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= _PACK_GRAMS:
                yield block(held)
                held = []
        if any(map(len, held)):
            yield block(held)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = twice = np.zeros(0, np.int64)

        def add(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            found, many = np.unique(np.concatenate(held), return_counts=True)
            known = np.isin(found, seen, assume_unique=True)
            return np.union1d(seen, found), np.union1d(twice, found[known | (many > 1)])

        held: list[np.ndarray] = []
        for batch in batches:
            held += [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("block")]
            if sum(map(len, held)) >= _PACK_GRAMS:
                seen, twice = add(held)
                held = []
        if held:
            seen, twice = add(held)
        yield pa.RecordBatch.from_arrays([pa.array(twice, pa.int64())], names=["gram"])

    return grams.select("gram").mapInArrow(pack, "shard int, block binary").repartition(parts, "shard").mapInArrow(merge, "gram long")


def _segments(met: DataFrame, p: Params) -> DataFrame:
    """(doc, start, stop, other, there): equal fingerprints that overlap and stand as far from each other's first place."""

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = batch.column("met")
            sizes = met.value_lengths().to_numpy(zero_copy_only=False)
            flat_met = met.flatten()
            first, other, there = (flat_met.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            doc = np.repeat(batch.column("doc").to_numpy(), sizes)
            shift = first - there
            order = np.lexsort([first, shift, other, doc])
            doc, first, other, shift = (x[order] for x in (doc, first, other, shift))
            new = np.ones(len(doc), bool)
            new[1:] = (first[1:] > first[:-1] + p.least_words) | (shift[1:] != shift[:-1]) | (other[1:] != other[:-1]) | (doc[1:] != doc[:-1])
            a = np.flatnonzero(new)
            last = np.append(a[1:], len(doc))[: len(a)] - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[a], pa.int64()), pa.array(first[a], pa.int32()), pa.array(first[last] + p.least_words, pa.int32()),
                    pa.array(other[a], pa.int64()), pa.array(first[a] - shift[a], pa.int32()),
                ],
                names=["doc", "start", "stop", "other", "there"],
            )

    return met.mapInArrow(chain, "doc long, start int, stop int, other long, there int")


def _around(texts: DataFrame, p: Params) -> DataFrame:
    """(doc, start, stop, other, there, before, after): every spot of a text with the hashes of the words around it, once per doc of a task."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text", SMALL_SLICE_BYTES):
            ids = part.column("doc").to_pylist()
            new = [k for k, x in enumerate(ids) if not (x in seen or seen.add(x))]
            part = part if len(new) == len(ids) else part.take(pa.array(new, pa.int64()))
            hashes, first, _ = _words(part)
            spots = part.column("spots")
            sizes = spots.value_lengths().to_numpy(zero_copy_only=False)
            places = spots.flatten()
            start, stop = (places.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            a, b = np.repeat(first[:-1], sizes), np.repeat(first[1:], sizes)
            sides = []
            for low, high in ((np.maximum(a, a + start - p.reach), a + start), (a + stop, np.minimum(b, a + stop + p.reach))):
                ends = np.concatenate([[0], np.cumsum(high - low)])
                at = np.arange(ends[-1]) + np.repeat(low - ends[:-1], high - low)
                sides.append(ragged(hashes[at].view(np.int64), ends, pa.int64()))
            doc = np.repeat(part.column("doc").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), *places.flatten(), *sides], names=["doc", "start", "stop", "other", "there", "before", "after"]
            )

    return texts.mapInArrow(read, "doc long, start int, stop int, other long, there int, before array<long>, after array<long>")


def _equal(x: pa.ListArray, y: pa.ListArray, back: bool) -> np.ndarray:
    """How many values two lists share from their starts on, or from their ends backwards, row by row."""
    (u, ends_u), (v, ends_v) = (
        (z.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(z.value_lengths().to_numpy(zero_copy_only=False))])) for z in (x, y)
    )
    room = np.minimum(np.diff(ends_u), np.diff(ends_v))
    i, j, step = (ends_u[1:] - 1, ends_v[1:] - 1, -1) if back else (ends_u[:-1], ends_v[:-1], 1)
    many, live, k = np.zeros(len(room), np.int64), np.flatnonzero(room > 0), 0
    while len(live):
        live = live[u[i[live] + step * k] == v[j[live] + step * k]]
        k += 1
        many[live] = k
        live = live[room[live] > k]
    return many


def _extended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, start, stop): words that equal those around the first place of the fingerprints."""
    for batch in batches:
        before = _equal(batch.column("before"), batch.column("before_there"), True)
        after = _equal(batch.column("after"), batch.column("after_there"), False)
        # Each word that goes equals one further to the front, so every word stays somewhere.
        start, stop = batch.column("start").to_numpy() - before, batch.column("stop").to_numpy() + after
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], names=["doc", "start", "stop"]
        )


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, starts, stops, now): older cuts, in words of the text, and runs, in words left by them, as one list in words of the
    text; ``now`` if there are runs."""
    for batch in batches:
        rows = np.arange(batch.num_rows) << 32  # a word number after its row's makes one number that sorts like both
        runs, many = batch.column("runs"), {n: batch.column(n).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for n in ("runs", "starts")}
        old_start, old_stop = (batch.column(n).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for n in ("starts", "stops"))
        start, stop = (runs.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
        old_row, row = np.repeat(rows, many["starts"]), np.repeat(rows, many["runs"])
        gone = np.concatenate([[0], np.cumsum(old_stop - old_start)])
        before = np.concatenate([[0], np.cumsum(many["starts"])])[:-1]
        # The words left before each older cut; a word goes back behind all cuts that have at most as many before them.
        left = old_row + old_start - (gone[:-1] - np.repeat(gone[before], many["starts"]))

        def back(word: np.ndarray) -> np.ndarray:
            return row + word + gone[np.searchsorted(left, row + word, "right")] - np.repeat(gone[before], many["runs"])  # noqa: B023

        a, b = np.concatenate([old_row + old_start, back(start)]), np.concatenate([old_row + old_stop, back(stop - 1) + 1])
        order = np.argsort(a, kind="stable")
        a, b = a[order], np.maximum.accumulate(b[order])
        new = np.ones(len(a), bool)
        new[1:] = a[1:] > b[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(a))[: len(first)] - 1
        ends = np.concatenate([[0], np.cumsum(np.bincount(a[first] >> 32, minlength=batch.num_rows))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), *(ragged((x & 0xFFFFFFFF).astype(np.int32), ends, pa.int32()) for x in (a[first], b[last])), pa.array(many["runs"] > 0)],
            names=["doc", "starts", "stops", "now"],
        )


def repeated_words(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc, starts, stops) for the texts of documents (doc, doc_id, text) that lose words: spans of word numbers.

    ``docs`` should be settled by ``doc`` (``settle_by``): every step joins texts with what it knows of them by that key.
    Of equal runs the one with the smallest doc_id (null last), then the first in the text, stays.
    Only fingerprints that stand twice get places; the others are dropped as bare numbers.
    Rounds go on until no fingerprint stands twice, so that a run whose first
    place shares only a part of it is finished against its other places. Only fingerprints beside
    a cut can stand twice anew, so later rounds read the texts with cuts and compare those.
    """
    p = params or Params()
    none = F.lit(None).cast("array<int>")
    uncut = settle(_fingerprints(docs.withColumns({"starts": none, "stops": none}), p), "fingerprints")
    cuts = docs.sparkSession.range(0).select(F.col("id").alias("doc"), none.alias("starts"), none.alias("stops"))
    recut: DataFrame | None = None
    again = settle(_repeated(uncut), "repeated")
    marks = settle(uncut.join(bounded(again), "gram", "left_semi"), "marks")
    discard(again)
    while True:
        place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "doc", "first")
        origins = settle(marks.groupBy("gram").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "origins")
        pairs = salted_join(
            marks.select("gram", "doc", "first"), origins.drop("_n"), ["gram"], F.struct("doc", "first"), counts=origins.select("gram", "_n")
        ).where((F.col("doc") != F.col("origin.doc")) | (F.col("first") != F.col("origin.first")))
        one = F.struct("first", F.col("origin.doc").alias("other"), F.col("origin.first").alias("there"))
        segments = settle(_segments(pairs.groupBy("doc").agg(F.collect_list(one).alias("met")), p), "segments")
        discard(origins, marks)
        if segments.isEmpty():
            discard(segments, uncut, *([] if recut is None else [recut]))
            return cuts
        there_stop = F.col("there") + F.col("stop") - F.col("start")
        met_by = settle(segments.groupBy("other", "there", there_stop.alias("there_stop")).agg(F.count(F.lit(1)).alias("_n")), "counts")
        # The places of the runs, with what they equal, and once each the places that these equal, with nothing.
        theirs = met_by.select(F.col("other").alias("doc"), F.col("there").alias("start"), F.col("there_stop").alias("stop"))
        spots = segments.unionByName(theirs, allowMissingColumns=True).groupBy("doc").agg(
            F.collect_list(F.struct("start", "stop", "other", "there")).alias("spots")
        )
        known = spots.join(cuts, "doc", "left").hint("shuffle_hash")
        around = settle(_around(docs.join(known, "doc"), p), "around")
        there = around.where("other is null").select("doc", "start", "stop", "before", "after").toDF(
            "other", "there", "there_stop", "before_there", "after_there"
        )
        whole = around.where("other is not null").withColumn("there_stop", there_stop)
        found = salted_join(whole, there, ["other", "there", "there_stop"], "doc", counts=met_by).mapInArrow(
            _extended, "doc long, start int, stop int"
        )
        runs = found.distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
        both = settle(runs.join(cuts, "doc", "full").mapInArrow(_united, "doc long, starts array<int>, stops array<int>, now boolean"), "cuts")
        discard(segments, around, met_by, cuts)
        cuts, changed = both.drop("now"), both.where("now").drop("now")
        # Texts without a new cut keep the fingerprints that they have; those of equal runs there have been compared.
        redone = settle(_fingerprints(docs.join(changed.hint("shuffle_hash"), "doc"), p), "fingerprints")
        fresh = settle(redone.where("fresh").select("gram").distinct(), "fresh")
        if recut is not None:
            kept = settle(recut.join(bounded(changed.select("doc")), "doc", "left_anti").unionByName(redone), "fingerprints")
            discard(recut, redone)
            redone = kept
        recut = redone
        grams = bounded(fresh)
        old = uncut.join(grams, "gram", "left_semi").join(bounded(cuts.select("doc")), "doc", "left_anti")
        marks = settle(old.unionByName(recut.join(grams, "gram", "left_semi")), "marks")
        discard(fresh)


def _rewritten(text: bytes, starts: list[int], stops: list[int]) -> tuple[bytes, list[int], int]:
    """The text without the words of the given spans, the numbers of the lines that lost every word, and how many words went.

    A line that lost every word goes with its line feed; in another, the blanks after a word go with it.
    """
    data = np.frombuffer(text + b"\n", np.uint8)  # every line ends; the last line feed left is not of the text
    blank = SPACE[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True))
    begin, end = edges[::2], edges[1::2]
    gone = np.zeros(len(begin), bool)
    for a, b in zip(starts, stops, strict=True):
        gone[a:b] = True
    feeds = np.flatnonzero(data == 10)
    line = np.searchsorted(feeds, begin)
    left = np.bincount(line[~gone], minlength=len(feeds))
    lost = np.flatnonzero((left == 0) & (np.bincount(line, minlength=len(feeds)) > 0))
    last = np.append(line[1:] != line[:-1], True)
    # In a line that keeps words: each one gone, and the blanks after it and after the last one left, but not those at the line's end.
    final = np.zeros(len(begin), bool)
    kept = np.flatnonzero(~gone)
    final[kept] = np.append(line[kept[1:]] != line[kept[:-1]], True)[: len(kept)]
    words, blanks = np.flatnonzero(gone), np.flatnonzero((gone | final) & ~last)
    change = np.zeros(len(data) + 1, np.int32)
    begins = np.concatenate([begin[words], end[blanks], np.append(0, feeds[:-1] + 1)[lost]])
    ends = np.concatenate([end[words], begin[blanks + 1], feeds[lost] + 1])
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    return data[np.cumsum(change[:-1]) == 0].tobytes()[:-1], lost.tolist(), len(words)


def dedup_lines(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """All rows and columns of documents (doc_id, text), without later repeated runs of words in ``text``;
    ``removed_lines``, the numbers (from 0) of the lines that lost every word, and ``removed_words``, how many words went.

    Runs start and end at any word, cross line feeds and are compared with A-Z lower-cased. A line
    that lost every word is taken out; lines without words stay. A null text stays null, an empty one empty.
    Rows that repeat both doc_id and text are one document: they lose the same
    words and are not compared with each other. Input columns with the new names
    are replaced; other columns, whatever their names, stay. All rows are written once, in buckets.
    """
    docs = docs.drop("removed_lines", "removed_words").withColumn("text", F.col("text").cast("string"))
    key = unused(docs, "line_doc")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64
    docs = settle_by(docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))), key, size, "texts")
    cuts = repeated_words(docs.select(F.col(key).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text"), params)
    cuts = cuts.select(F.col("doc").alias(key), F.col("starts").alias("removed_lines"), F.col("stops").alias("removed_words"))
    joined = docs.join(cuts.hint("shuffle_hash"), key, "left").drop(key)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    place, names = joined.columns.index("text"), joined.columns

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = batch.column("text"), batch.columns[-2:]
            many = spans[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            hit = pa.array(np.flatnonzero(many))
            texts, lines, counts = [], [], np.zeros(len(many), np.int64)
            for at, *row in zip(hit.to_pylist(), text.take(hit).cast(pa.binary()).to_pylist(), *(x.take(hit).to_pylist() for x in spans), strict=True):
                new, cut, counts[at] = _rewritten(*row)
                texts.append(new)
                lines.append(cut)
            sizes = np.zeros(len(many), np.int64)
            sizes[many > 0] = [len(x) for x in lines]
            numbers = np.array([x for cut in lines for x in cut], np.int32)
            columns = list(batch.columns)
            columns[place] = pc.replace_with_mask(text, pa.array(many > 0), pa.array(texts, pa.binary()).cast(text.type)) if texts else text
            columns[-2:] = ragged(numbers, np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(rewrite, f"{fields}, removed_words long")
