"""Near-duplicates: universal hash minima, bands, verified links, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.components import components
from colweave.llm.tables import ONE_TASK_ROWS, bounded, discard, salted_join, settle, settle_few
from colweave.llm.text import (
    LOWER, NOT_SPACE, SMALL_SLICE_BYTES, blobs, flat, mix, ragged, shingles, slices, span_hash, unique_per_text, word_spans,
)


@dataclass(frozen=True)
class Params:
    """``words`` per shingle, links at ``percent`` of similarity or more, ``bands`` of ``rows`` minima.

    A pair at similarity s shares a band with probability 1 - (1 - s^rows)^bands:
    all but 7 in a million pairs at 0.8 with the defaults. ``spare`` is how far
    below the limit a signature's estimate may lie before the exact check is
    skipped (4.5 standard deviations by default). A task compares at most two
    blocks of ``block`` texts.
    """

    words: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 5
    spare: float = 0.15
    block: int = 768

    @property
    def least_equal(self) -> int:
        return int((self.percent / 100 - self.spare) * self.bands * self.rows)


def _shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_SPACE)
    return unique_per_text(*shingles(span_hash(low, starts, ends), first, words))


def _names(values: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """16 bytes per text that stand for its set: two sums over differently mixed members; none for an empty set."""
    sums = []
    for salt in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(salt)), dtype=np.uint64)])
        sums.append(total[offsets[1:]] - total[offsets[:-1]])
    sizes = np.diff(offsets)
    raw = np.ascontiguousarray(np.stack([mix(sums[0] + sizes.astype(np.uint64)), sums[1]], 1)).tobytes()
    return [raw[16 * k : 16 * k + 16] if n else None for k, n in enumerate(sizes.tolist())]


def _minima(values: np.ndarray, offsets: np.ndarray, p: Params) -> np.ndarray:
    """A row of minima under universal hashes for every text; zeros for an empty set."""
    rng = np.random.default_rng(20)
    n = p.bands * p.rows
    a = rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, n, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, n), np.uint32)
    x = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
    for k in range(n if len(full) else 0):
        out[full, k] = np.minimum.reduceat(x * a[k] + b[k], offsets[full])
    return out


def _sketches(docs: DataFrame, p: Params) -> DataFrame:
    """(doc_id, n_shingles, node, bands): ``node`` names the shingle set, ``bands`` are hashes of its bands of minima."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SMALL_SLICE_BYTES):
            values, offsets = _shingle_sets(part.column("text"), p.words)
            minima = _minima(values, offsets, p).astype(np.uint64).reshape(part.num_rows, p.bands, p.rows)
            key = np.broadcast_to(np.arange(p.bands, dtype=np.uint64), minima.shape[:2])
            for k in range(p.rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, k])
            bands = ragged(key.ravel().view(np.int64), np.arange(part.num_rows + 1) * p.bands, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(_names(values, offsets), pa.binary()), bands],
                names=["doc_id", "n_shingles", "node", "bands"],
            )

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, node binary, bands array<long>")


def _details(docs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """(node, sig, shingles) of the given nodes (node, doc_id): minima and whole set, from the text of one document each."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SMALL_SLICE_BYTES):
            values, offsets = _shingle_sets(part.column("text"), p.words)
            sig = blobs(_minima(values, offsets, p).ravel(), np.arange(part.num_rows + 1) * p.bands * p.rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_names(values, offsets), pa.binary()), sig, blobs(values, offsets)], names=["node", "sig", "shingles"]
            )

    chosen = docs.join(bounded(nodes.select("doc_id").distinct()), "doc_id", "left_semi").select("text")
    return chosen.mapInArrow(gather, "node binary, sig binary, shingles binary")


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """One pair per node: the node and the hub it shares most bands with.

    A band's hub is its member with most company over all bands, which is the
    text that the others were copied from rather than one of the copies.
    """
    company = buckets.groupBy("node").agg(F.sum("n").alias("company"))
    ranked = buckets.join(company, "node")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("company", "node"))["node"].alias("hub"))
    met = ranked.join(hubs, "band").where(F.col("node") != F.col("hub")).groupBy("node", "hub").agg(F.count(F.lit(1)).alias("shared"))
    best = met.groupBy("node").agg(F.max(F.struct("shared", "hub"))["hub"].alias("v"))
    return best.select(F.col("node").alias("u"), "v")


def _linked(pairs: DataFrame, details: DataFrame, p: Params) -> DataFrame:
    """Those of the pairs (u, v) whose signatures agree enough and whose whole sets are similar enough."""

    def similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r in batch.select(["sig", "sig_v", "shingles", "shingles_v"]).to_pylist():
                agree = (np.frombuffer(r["sig"], np.uint32) == np.frombuffer(r["sig_v"], np.uint32)).sum()
                x, y = np.frombuffer(r["shingles"], np.uint64), np.frombuffer(r["shingles_v"], np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True)) if agree >= p.least_equal else 0
                keep.append(100 * common >= p.percent * (len(x) + len(y) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    hubs = details.select(F.col("node").alias("v"), F.col("sig").alias("sig_v"), F.col("shingles").alias("shingles_v"))
    hubs = hubs.join(bounded(pairs.select("v").distinct()), "v", "left_semi")
    met = salted_join(pairs, hubs, ["v"], "u", 2_000).join(details.withColumnRenamed("node", "u"), "u")
    return met.mapInArrow(similar, "u binary, v binary").distinct()


def _compared(members: DataFrame, details: DataFrame, p: Params) -> DataFrame:
    """Links (u, v) that join the components of a cluster, from members (cluster, node, component).

    A cluster holds all nodes that bands connect, so every candidate pair lies in one. Its largest component
    need not be compared with itself: its blocks meet the blocks of the other nodes, and those meet each other. A
    task has the signatures and sets of two blocks, and gives only the links that join what was apart.
    """
    parts = members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    first = F.when(F.col("top.n") > 1, F.col("top.n")).otherwise(0)
    plan = main.select(
        "cluster", F.when(F.col("top.n") > 1, F.col("top.component")).alias("main"),
        F.ceil((F.col("all") - first) / p.block).cast("int").alias("others"), F.ceil(first / p.block).cast("int").alias("mains"),
    ).where("others > 0 and (main is null or others + mains > 0)")
    code = F.xxhash64("node")
    placed = members.join(plan, "cluster").withColumn("is_main", F.coalesce(F.col("component") == F.col("main"), F.lit(False)))
    placed = placed.withColumn(
        "mine", F.when(F.col("is_main"), F.col("others") + F.pmod(code, F.col("mains"))).otherwise(F.pmod(code, F.col("others"))).cast("int")
    ).withColumn("meets", F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("others") - 1)).otherwise(F.sequence(F.lit(0), F.col("others") + F.col("mains") - 1)))
    placed = settle_few(placed.select("cluster", "node", "component", "mine", "meets"), "placed")
    dealt = details.join(bounded(placed, 300_000), "node").withColumn("meet", F.explode("meets")).select(
        F.concat(F.hex("cluster"), F.lit(" "), F.least("mine", "meet"), F.lit(" "), F.greatest("mine", "meet")).alias("pair"),
        F.least("mine", "meet").alias("i"), F.greatest("mine", "meet").alias("j"), "mine", "node", "component", "sig", "shingles",
    )

    def links(rows: dict[str, list]) -> list[tuple[bytes, bytes]]:
        """Exact links within one pair of blocks, as a spanning forest of the components."""
        head: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while head.get(x, x) != x:
                head[x] = head.get(head[x], head[x])
                x = head[x]
            return x

        mine, i, j = np.array(rows["mine"]), rows["i"][0], rows["j"][0]
        a, b = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        if not len(a) or not len(b) or len(mine) < 2:
            return []
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint32).reshape(len(mine), -1)
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        sizes = np.array([len(s) for s in sets])
        known, local = np.unique(np.concatenate([sets[k] for k in b]), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(sizes[b])])
        out = []
        for x in a.tolist():
            near = (sig[x] == sig[b]).sum(1) >= p.least_equal
            near &= b > x if i == j else True
            rest = [k for k in np.flatnonzero(near).tolist() if find(rows["component"][b[k]]) != find(rows["component"][x])]
            if not rest:
                continue
            marked = np.zeros(len(known) + 1, bool)
            at = np.minimum(np.searchsorted(known, sets[x]), len(known) - 1)
            marked[at[known[at] == sets[x]]] = True
            if len(rest) > 8:
                shared = np.add.reduceat(marked[local], ends[:-1], dtype=np.int64)[rest]
            else:
                shared = [int(marked[local[ends[k] : ends[k + 1]]].sum()) for k in rest]
            for k, common in zip(rest, shared, strict=True):
                y = int(b[k])
                if 100 * common >= p.percent * (sizes[x] + sizes[y] - common):
                    u, v = find(rows["component"][x]), find(rows["component"][y])
                    if u != v:
                        head[max(u, v)] = min(u, v)
                        out.append((rows["node"][x], rows["node"][y]))
        return out

    names = ["pair", "i", "j", "mine", "node", "component", "sig", "shingles"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {n: [] for n in names}
        found: list[tuple[bytes, bytes]] = []
        for batch in batches:
            pair = batch.column("pair").to_pylist()
            cuts = [0, *[k for k in range(1, len(pair)) if pair[k] != pair[k - 1]], len(pair)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held["pair"] and lo < hi and held["pair"][0] != pair[lo]:
                    found += links(held)
                    held = {n: [] for n in names}
                part = batch.slice(lo, hi - lo)
                for n in names:
                    held[n] += part.column(n).to_pylist()
        if held["pair"]:
            found += links(held)
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["u", "v"])

    return dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(compare, "u binary, v binary")


def near_duplicates(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents (doc_id, text).

    A text's set holds its distinct runs of ``words`` lower-cased words (the
    whole text if it is shorter); null, empty and blank texts have none and are
    linked with nothing. ``component_id`` is the smallest doc_id reachable over
    links and ``kept`` marks it. A row without doc_id is its own component (null) and stays;
    repeated rows share their component. Other columns are not read.

    Equal sets are one node from the start, so copies are never paired. Nodes that share a band
    form clusters, and all candidates lie inside one. Clusters larger than a block are first thinned out by verified
    links to the text with most company; then the components left in a cluster are compared block by block.
    """
    p = params or Params()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = settle(_sketches(docs, p), "sketches")
    named = rows.where(F.col("doc_id").isNotNull() & F.col("node").isNotNull())
    nodes = settle(named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")), "nodes")

    ids = settle_few(nodes.select("node", "doc_id"), "ids")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).where("n > 1")
    buckets = settle(bands.join(shared, "band"), "buckets")
    grouped = components(buckets.select(F.col("node").alias("u"), F.col("least").alias("v"))).withColumnRenamed("component", "cluster")
    clusters = settle_few(ids.join(bounded(grouped), "node"), "clusters")
    large = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > p.block).select("cluster")
    crowded = settle_few(clusters.join(large, "cluster", "left_semi"), "crowded")
    met = settle_few(buckets.join(bounded(crowded.select("node")), "node", "left_semi"), "met")
    stars = settle_few(_linked(settle_few(_hub_pairs(met), "pairs"), _details(docs, crowded, p), p), "stars")
    found = components(stars)
    members = clusters.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("doc_id")
    rest = settle_few(_compared(members, _details(docs, clusters, p), p), "rest")
    discard(buckets, clusters, crowded, met)

    # A node without links is its own component.
    joined = settle_few(ids.join(bounded(components(stars.union(rest))), "node"), "joined")
    names = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = settle_few(joined.join(names, "component").select("node", "component_id"), "linked")
    classes = settle(ids.join(bounded(linked), "node", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id")), "classes")
    discard(stars, rest, nodes, ids, joined, linked)
    known = F.col("doc_id").isNotNull()
    of = F.when(known, F.coalesce("component_id", "doc_id"))
    return rows.drop("bands").join(bounded(classes, ONE_TASK_ROWS), "node", "left").select(
        "doc_id", "n_shingles", of.alias("component_id"), (~known | (F.col("doc_id") == of)).alias("kept")
    )
