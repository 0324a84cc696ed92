"""Words, hashes and batches of text as arrays, for use inside Arrow tasks.

Texts travel as one byte array per slice with offsets per document, so that
memory is bounded by the slice (or by one document, if that is longer) and all
work per byte and per word is done by array operations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
# For work that holds many 64-bit numbers per byte or word of a slice: they stay in the cache, and a task's memory stays small.
SMALL_SLICE_BYTES = 512 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~SPACE


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes in each, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets per text); a null is an empty text."""
    array = pc.fill_null(column.cast(pa.large_binary()), b"")
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if not len(array) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _powers[k] = np.cumprod(grown, dtype=np.uint64)
    return _powers


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for every span, by one running sum over all bytes."""
    up, down = _powers_to(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word per text): runs of bytes that ``table`` allows, cut at text ends."""
    allowed = table[data]
    n, inner = len(data), offsets[(offsets > 0) & (offsets < len(data))]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = allowed[:-1], allowed[1:]
    before[inner], after[inner - 1] = False, False
    starts, ends = np.flatnonzero(allowed & ~before), np.flatnonzero(allowed & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of all runs of ``size`` words; a shorter text is one run of all its words."""
    counts = np.diff(first)
    many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(many)])
    if not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    start = np.repeat(first[:-1] - offsets[:-1], many) + np.arange(offsets[-1])
    width = np.repeat(np.minimum(counts, size), many)
    out = width.astype(np.uint64)
    for k in range(size):
        inside = width > k
        at = np.minimum(start + k, len(words) - 1)
        out = np.where(inside, out * _BASE + words[at], out)
    return mix(out), offsets


def unique_per_text(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every text, and their offsets."""
    parts = [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum(sizes)])


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def blobs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column that holds each text's values as raw bytes."""
    width = values.dtype.itemsize
    raw = np.ascontiguousarray(values).tobytes()
    return pa.array([raw[a * width : b * width] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())


def pieces(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, limit: int = SLICE_BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, first text) of parts of at most ``limit`` bytes: all texts at once, or one long text bit by bit.

    A long text is cut between words (runs of bytes that ``inside`` allows), so no word is lost, split or counted
    twice; a part is longer only for a single word that is.
    """
    if len(data) <= 2 * limit or len(offsets) > 2:
        yield data, offsets, 0
        return
    at = 0
    while at < len(data):
        stop = min(len(data), at + limit)
        while stop < len(data) and inside[data[stop]] and inside[data[stop - 1]]:
            cuts = np.flatnonzero(~inside[data[at:stop]])
            if len(cuts):
                stop = at + int(cuts[-1]) + 1
            else:
                ahead = np.flatnonzero(~inside[data[stop : stop + limit]])
                stop = stop + int(ahead[0]) if len(ahead) else min(len(data), stop + limit)
        yield data[at:stop], np.array([0, stop - at], np.int64), 0
        at = stop
