"""Shards of near-equal bytes by histogram sort: probes, exact counts, one exchange."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colweave.llm.tables import discard, settle, unused

ROW_BYTES = 8
_HALF = 1 << 63


@dataclass(frozen=True)
class Params:
    """``shards`` to fill; cuts may be off by ``tolerance`` of a part's bytes, unless a single row is larger.

    Rows are exchanged in parts of a shard of about ``part_bytes``, at least
    ``least_parts`` in each shard and ``most_parts`` in all; ``probes`` candidate
    boundaries are tried per unsettled cut and round.
    """

    shards: int = 24
    tolerance: float = 0.01
    part_bytes: int = 64 << 20
    least_parts: int = 4
    most_parts: int = 8192
    probes: int = 16


def _pair(key: int) -> tuple[int, int]:
    """A 128-bit key as two signed 64-bit numbers, in the same order."""
    return (key >> 64) - _HALF, (key & ((1 << 64) - 1)) - _HALF


def _key(high: int, low: int) -> int:
    return ((high + _HALF) << 64) | (low + _HALF)


def _bounds(cuts: list[int]) -> np.ndarray:
    """Ascending cuts as two rows of signed numbers: upper and lower halves."""
    return np.array([_pair(c) for c in cuts], np.int64).reshape(-1, 2).T


def _below(high: np.ndarray, low: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every row the number of cuts that are not above its key; lower halves are searched where the upper ones are equal."""
    top, own = bounds
    out, stop = np.searchsorted(top, high, "left"), np.searchsorted(top, high, "right")
    live = np.flatnonzero(out < stop)
    while len(live):
        middle = (out[live] + stop[live]) // 2
        up = own[middle] <= low[live]
        out[live[up]] = middle[up] + 1
        stop[live[~up]] = middle[~up]
        live = live[out[live] < stop[live]]
    return out


def _histogram(keys: DataFrame, cuts: list[int]) -> dict[int, tuple[int, int, int]]:
    """Bucket -> (bytes, smallest key, largest key), with exact bytes; one small row per task and bucket."""
    bounds = _bounds(cuts)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, size = (batch.column(c).to_numpy() for c in ("high", "low", "size"))
            bucket = _below(high, low, bounds)
            order = np.lexsort((low, high, bucket))
            found, at = np.unique(bucket[order], return_index=True)
            last = np.append(at[1:], len(order)) - 1
            total = np.add.reduceat(size[order], at) if len(at) else size[:0]
            ends = [order[at], order[last]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(total, pa.int64())] + [pa.array(k[e], pa.int64()) for e in ends for k in (high, low)],
                names=["bucket", "size", "h0", "l0", "h1", "l1"],
            )

    parts = keys.mapInArrow(count, "bucket int, size long, h0 long, l0 long, h1 long, l1 long")
    sums = parts.groupBy("bucket").agg(
        F.sum("size").alias("size"), F.min(F.struct("h0", "l0")).alias("lo"), F.max(F.struct("h1", "l1")).alias("hi")
    )
    return {r.bucket: (r.size, _key(*r.lo), _key(*r.hi)) for r in sums.collect()}


def _splitters(keys: DataFrame, parts: int, total: int, p: Params) -> list[int]:
    """Keys that cut the rows into ``parts`` parts of near-equal bytes.

    Every cut has a bracket of keys with the exact bytes below it. A round
    probes all open brackets at once, and each bracket shrinks to the keys that
    were really seen in the bucket of its target, so a hot key or an empty
    stretch of the key space costs no extra rounds.
    """
    slack = p.tolerance * total / parts
    target = [total * k / parts for k in range(1, parts)]
    bracket = {k: (0, (1 << 128) - 1) for k in range(len(target))}
    done: dict[int, int] = {}
    while bracket:
        probes = set()
        for (lo, hi), cuts_inside in Counter(bracket.values()).items():
            inside = p.probes * cuts_inside
            step = max(1, (hi - lo) // (inside + 1))
            probes.update(lo + step * i for i in range(1, inside + 1) if lo + step * i <= hi)
            probes.update((lo, hi))
        cuts = sorted(probes)
        seen = _histogram(keys, cuts)
        order = sorted(seen)
        ends = np.cumsum([seen[b][0] for b in order])
        for k in list(bracket):
            i = int(np.searchsorted(ends, target[k], "left"))
            size, lo, hi = seen[order[i]]
            before, after = float(ends[i] - size), float(ends[i])
            if target[k] - before <= slack or (lo == hi and target[k] - before <= after - target[k]):
                done[k] = lo
            elif after - target[k] <= slack or lo == hi:
                done[k] = min(hi + 1, (1 << 128) - 1)
            else:
                bracket[k] = (lo, hi)
                continue
            del bracket[k]
    return [done[k] for k in sorted(done)]


def shard(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """All rows and columns of documents (doc_id, text) with ``size``, ``shard`` and ``slot``.

    Rows are ordered by a hash of the text, then doc_id, so that equal texts lie
    together, and the order is cut into shards of near-equal ``size``: UTF-8 bytes of
    the text (null: none) plus 8. ``slot`` counts a shard's rows from 0 without
    gaps. A null doc_id comes first among equal texts, and rows equal in both
    keep one place in the order, whichever comes first. An empty table
    gives an empty result. Input columns that are called size, shard or slot
    are replaced; others, whatever their names, stay.

    The keys are settled once (24 bytes a row), each round of the histogram sort
    reads only them, and the texts are exchanged once, by part; a hot group of
    equal texts is cut between its doc_ids like any other stretch of the order.
    """
    p = params or Params()
    docs = docs.drop("size", "shard", "slot")
    above, beneath, within = (unused(docs, name) for name in ("text_hash", "id_order", "part"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({
        "size": (F.octet_length(text) + ROW_BYTES).cast("long"),
        above: F.xxhash64(text),
        beneath: F.coalesce(F.col("doc_id").cast("long"), F.lit(-_HALF)),
    })
    keys = settle(marked.select(F.col(above).alias("high"), F.col(beneath).alias("low"), "size"), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    each = min(max(p.least_parts, -(-total // (p.shards * p.part_bytes))), max(1, p.most_parts // p.shards))
    cuts = _splitters(keys, p.shards * each, total, p) if total else []
    bounds = _bounds(cuts)

    def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = _below(batch.column(above).to_numpy(), batch.column(beneath).to_numpy(), bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=[*batch.schema.names, within])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    placed = marked.mapInArrow(locate, f"{kinds}, `{within}` int")
    counts = [0] * (p.shards * each)
    for row in keys.withColumnsRenamed({"high": above, "low": beneath}).mapInArrow(
        locate, f"`{above}` long, `{beneath}` long, size long, `{within}` int"
    ).groupBy(within).count().collect():
        counts[row[within]] = row["count"]
    discard(keys)
    before = [sum(counts[k - k % each : k]) for k in range(len(counts))]
    offset = F.array(*[F.lit(b).cast("long") for b in before])
    in_part = F.row_number().over(Window.partitionBy(within).orderBy(above, beneath))
    return placed.withColumns({
        "shard": (F.col(within) / each).cast("int"),
        "slot": (F.element_at(offset, F.col(within) + 1) + in_part - 1).cast("long"),
    }).drop(above, beneath, within)
