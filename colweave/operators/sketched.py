"""Correlated columns of very wide tables: sketches find the pairs, exact sums decide them.

The matrix of all pairs grows with the square of the width, in work and in
driver memory. Here every column is drawn onto a few hundred random directions
in one pass, columns that point the same way meet by locality-sensitive
hashing, and only those pairs get exact sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.select import BATCH_BYTES, CORRELATION_LIMIT, ROUNDING, correlated_columns, pair_correlations
from colweave.schema import KEY, quoted


@dataclass(frozen=True)
class Sketch:
    """``directions`` random directions; columns meet that agree in all ``band`` bits of one of directions / band bands.

    At a correlation of 0.95 two columns differ in one bit of ten. All 42 bands of 12 bits miss such a pair with a
    chance of 1.1 in a million, so the recall at the limit is 0.999999 and higher above it. A pair goes on to the exact
    sums if its sketched correlation is within ``slack`` standard errors of the limit.
    """

    directions: int = 504
    band: int = 12
    slack: float = 6.0
    pairs_per_pass: int = 100_000


def _signs(keys: np.ndarray, directions: int) -> np.ndarray:
    """Random signs (row x direction) that follow from the row's key alone."""
    word = np.arange(-(-directions // 64), dtype=np.uint64) + np.uint64(1)
    x = (keys.astype(np.int64).view(np.uint64)[:, None] + word * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.view(np.uint8), axis=1)[:, :directions]
    return bits.astype(float) * 2 - 1


def _added(parts: DataFrame, spread: int = 32) -> np.ndarray:
    """The sum of all arrays, in two steps, so that the driver gets one."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("sums").to_pylist():
                total = np.frombuffer(raw) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    dealt = parts.withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(spread))).repartition(spread, "bucket").drop("bucket")
    found = dealt.mapInArrow(add, "sums binary").coalesce(1).mapInArrow(add, "sums binary").collect()
    return np.frombuffer(found[0]["sums"]) if found else np.zeros(0)


def _rows(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, values) of a few rows at a time."""
    step = max(1, BATCH_BYTES // (8 * width))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            values = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns[1:]], 1).astype(float)
            yield part.column(0).to_numpy(zero_copy_only=False), values


class _Table:
    """The named columns as numbers, shifted by the first row that has all of them (correlations do not change)."""

    def __init__(self, df: DataFrame, names: Sequence[str]):
        self.width = len(names)
        key = f"cast({quoted(KEY)} as bigint)" if KEY in df.columns else f"xxhash64({', '.join(map(quoted, names))})"
        self.plain = df.selectExpr(f"coalesce({key}, 0L) as _key", *[f"cast({quoted(n)} as double) as _f{i}" for i, n in enumerate(names)])
        first = self.plain.limit(1).collect()
        shift = np.array(first[0][1:], float) if first else np.zeros(self.width)
        self.shift = np.where(np.isfinite(shift), shift, 0.0)

    def sketch(self, directions: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows, values per column, sums, sums of squares, sums of signs x centred values) in one pass."""
        width, shift = self.width, self.shift

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 + directions + width * (3 + directions))
            n, g, each = total[:1], total[1 : 1 + directions], total[1 + directions :].reshape(width, 3 + directions)
            for keys, x in _rows(batches, width):
                held = np.isfinite(x)
                x = np.where(held, x - shift, 0.0)
                signs = _signs(keys, directions)
                n += len(x)
                g += signs.sum(0)
                each[:, 0] += held.sum(0)
                each[:, 1] += x.sum(0)
                each[:, 2] += (x * x).sum(0)
                each[:, 3:] += x.T @ signs
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        total = _added(self.plain.mapInArrow(run, "sums binary"))
        if not len(total):
            total = np.zeros(1 + directions + width * (3 + directions))
        g, each = total[1 : 1 + directions], total[1 + directions :].reshape(width, 3 + directions)
        mean = each[:, 1] / max(1.0, total[0])
        return total[0], each[:, 0], each[:, 1], each[:, 2], each[:, 3:] - mean[:, None] * g

    def exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pearson r of the column pairs (a, b), which have no missing values; one pass."""
        used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        i, j, shift, width = place[: len(a)], place[len(a) :], self.shift[used], len(used)
        table = self.plain.select("_key", *[f"_f{k}" for k in used])
        step = max(1, BATCH_BYTES // (8 * max(1, len(a))))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 + 2 * width + len(i))
            for _, x in _rows(batches, width):
                x = x - shift
                total[0] += len(x)
                total[1 : 1 + width] += x.sum(0)
                total[1 + width : 1 + 2 * width] += (x * x).sum(0)
                for k in range(0, len(x), step):
                    total[1 + 2 * width :] += np.einsum("rp,rp->p", x[k : k + step, i], x[k : k + step, j])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        total = _added(table.mapInArrow(run, "sums binary"))
        n, mean, square, cross = total[0], total[1 : 1 + width] / total[0], total[1 + width : 1 + 2 * width] / total[0], total[1 + 2 * width :] / total[0]
        spread = square - mean * mean
        return (cross - mean[i] * mean[j]) / np.sqrt(spread[i] * spread[j]) if n else np.zeros(len(i))


def candidate_pairs(sketches: np.ndarray, limit: float, p: Sketch) -> list[tuple[int, int, float]]:
    """(earlier, later, sketched |r|) of the rows of ``sketches`` that meet in a band and may pass the limit.

    A later column keeps all partners near the limit, but of those clearly above it only the best: one is enough to
    drop it. So a thousand copies of a column give a thousand pairs, not half a million.
    """
    length = np.sqrt((sketches * sketches).sum(1, keepdims=True))
    unit = np.divide(sketches, length, out=np.zeros_like(sketches), where=length > 0)
    near = p.slack * (1 - limit * limit) / np.sqrt(p.directions)
    bits, best, more = unit > 0, {}, {}
    for start in range(0, p.directions - p.band + 1, p.band):
        own = bits[:, start : start + p.band]
        own = own ^ own[:, :1]  # a column and its negative have one signature
        name = own @ (1 << np.arange(p.band, dtype=np.int64))
        order = np.argsort(name, kind="stable")
        cuts = np.flatnonzero(np.append(True, name[order][1:] != name[order][:-1])).tolist() + [len(order)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            group = np.sort(order[lo:hi])
            for at in range(0, len(group), 256):
                later = group[at : at + 256]
                r = np.abs(unit[later] @ unit[group].T)
                r[group[None, :] >= later[:, None]] = 0.0
                for row, column in zip(*np.nonzero((r >= limit - near) & (r < limit + near)), strict=True):
                    more[int(group[column]), int(later[row])] = float(r[row, column])
                for row in np.flatnonzero((r >= limit + near).any(1)):
                    column = int(r[row].argmax())
                    if r[row, column] > best.get(int(later[row]), (0, 0.0))[1]:
                        best[int(later[row])] = (int(group[column]), float(r[row, column]))
    return [(i, j, r) for j, (i, r) in best.items()] + [(i, j, r) for (i, j), r in more.items()]


def correlated_columns_sketched(
    df: DataFrame, names: Sequence[str], limit: float = CORRELATION_LIMIT, sketch: Sketch | None = None
) -> list[str]:
    """The later column of every pair above the limit, as ``correlated_columns`` gives it, without the matrix.

    The driver holds one sketch per column and the pairs that may pass; work is rows x columns x directions. Every
    verdict rests on an exact correlation, so a column is never dropped wrongly; see ``Sketch`` for the recall.
    Columns with missing values cannot be sketched without bias: they are compared exactly with all others, missing
    values left out pair by pair. Limits of 0.5 and less are left to the matrix, where a sketch saves nothing.
    """
    p, names = sketch or Sketch(), list(names)
    if len(names) < 2:
        return []
    if limit <= 0.5:
        return correlated_columns(df, names, limit)
    table = _Table(df, names)
    n, held, total, square, sketches = table.sketch(p.directions)
    if not n:
        return []
    spread = square / n - (total / n) ** 2
    varies = spread > ROUNDING * (square / n + table.shift**2 * ROUNDING)
    whole = np.flatnonzero((held == n) & varies)
    gone: set[int] = set()
    pairs = [(int(whole[i]), int(whole[j]), r) for i, j, r in candidate_pairs(sketches[whole], limit, p)]
    pairs.sort(key=lambda x: -x[2])
    while pairs:  # strongest partners first; a column that is out needs no more of them
        chosen, later = [], set()
        for pair in pairs:
            if pair[1] not in later and len(chosen) < p.pairs_per_pass:
                later.add(pair[1])
                chosen.append(pair)
        if len(pairs) - len(chosen) < p.pairs_per_pass - len(chosen):
            chosen = pairs
        a, b = np.array([x[0] for x in chosen]), np.array([x[1] for x in chosen])
        gone |= {int(j) for j in b[np.abs(table.exact(a, b)) > limit]}
        done = {x[:2] for x in chosen}
        pairs = [x for x in pairs if x[1] not in gone and x[:2] not in done]
    partly = [i for i in range(len(names)) if 0 < held[i] < n]
    if partly:
        r = np.nan_to_num(np.abs(pair_correlations(df, [names[i] for i in partly], names)))
        for i, row in zip(partly, r, strict=True):
            if (row[:i] > limit).any():
                gone.add(i)
            gone |= {int(j) for j in np.flatnonzero(row > limit) if j > i}
    return [names[i] for i in sorted(gone)]
