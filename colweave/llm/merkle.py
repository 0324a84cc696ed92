"""Merkle manifest of a dataset: a hash tree per language, one tree over their roots, and an inclusion proof per row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colweave.llm.tables import bounded, discard, settle
from colweave.operators.order import dense_codes, range_sorted

PATH = "array<struct<before:string,after:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Params:
    """Every ``fanout`` consecutive nodes have one parent; one pivot spreads up to ``width`` nodes, so several levels at once."""

    fanout: int = 2
    width: int = 16

    @property
    def levels(self) -> int:
        k = 1
        while self.fanout ** (k + 1) <= self.width:
            k += 1
        return k


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(changed: Mapping[str, Column] | None = None) -> Column:
    """Hash of a documents row; ``changed`` puts other values in place of columns."""
    values = {name: F.col(name) for name in FIELDS} | dict(changed or {})
    return F.sha2(F.concat(*[field(values[name]) for name in FIELDS]), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, start, lambda h, level: F.sha2(F.concat(level["before"], h, level["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""), 256)


# The expressions below are SQL text: hundreds of Column objects would cost the driver seconds.


def _height(n: str, p: Params) -> Column:
    """Levels above ``n`` nodes until one is left."""
    steps, size = [], 1
    while size < 1 << 62:
        steps.append(f"if({n} > {size}, 1, 0)")
        size *= p.fanout
    return F.expr(" + ".join(steps))


def _pivot(nodes: DataFrame, base: int, p: Params) -> DataFrame:
    """One row per block of nodes: ``x0``, ``x1``, ... hold its nodes by slot, ``n{level}_{place}`` the hashes of all levels inside.

    ``nodes`` has (tree, height, i, x) with x a struct whose field ``h`` is the hash. ``base`` is the level of the
    nodes; from a tree's own height on, its single node passes as it is.
    """
    size = p.fanout**p.levels
    cells = [F.expr(f"max(if(i % {size} = {k}, x, null)) as x{k}") for k in range(size)]
    out = nodes.groupBy("tree", "height", F.expr(f"i div {size} as block")).agg(*cells)
    out = out.selectExpr("*", *[f"x{k}.h as n0_{k}" for k in range(size)])
    for level in range(p.levels):
        size //= p.fanout
        above = []
        for k in range(size):
            run = [f"n{level}_{j}" for j in range(k * p.fanout, (k + 1) * p.fanout)]
            joined = f"if({base + level} < height, sha2(concat_ws('', {', '.join(run)}), 256), {run[0]})"
            above.append(f"if({run[0]} is null, null, {joined}) as n{level + 1}_{k}")
        out = out.selectExpr("*", *above)
    return out


def _paths(pivot: DataFrame, above: DataFrame, base: int, p: Params) -> DataFrame:
    """(tree, height, i, x, path) of every node of a pivot; ``above`` has the path of each block (tree, block, path)."""
    size = p.fanout**p.levels
    inside = f"greatest(0, least({p.levels}, height - {base}))"
    nodes = []
    for slot in range(size):
        steps, place = [], slot
        for level in range(p.levels):
            first = place - place % p.fanout
            left = ["''", *[f"n{level}_{j}" for j in range(first, place)]]
            right = ["''", *[f"n{level}_{j}" for j in range(place + 1, first + p.fanout)]]
            steps.append(f"named_struct('before', concat_ws({', '.join(left)}), 'after', concat_ws({', '.join(right)}))")
            place //= p.fanout
        here = f"concat(slice(array({', '.join(steps)}), 1, {inside}), path)"
        nodes.append(f"named_struct('slot', {slot}, 'x', x{slot}, 'path', {here})")
    each = pivot.join(above, ["tree", "block"]).selectExpr("tree", "height", "block", f"explode(array({', '.join(nodes)})) as node")
    return each.where("node.x is not null").selectExpr("tree", "height", f"block * {size} + node.slot as i", "node.x", "node.path")


def _grow(nodes: DataFrame, most: int, p: Params) -> tuple[list[DataFrame], DataFrame]:
    """(settled pivots from the leaves up, (tree, h) of the roots); ``most`` is the size of the largest tree."""
    rounds, span = 1, p.fanout**p.levels
    while span < most:
        rounds, span = rounds + 1, span * p.fanout**p.levels
    pivots = []
    for k in range(rounds):
        pivots.append(settle(_pivot(nodes, k * p.levels, p), f"pivot-{k}"))
        nodes = pivots[-1].select("tree", "height", F.col("block").alias("i"), F.struct(F.col(f"n{p.levels}_0").alias("h")).alias("x"))
    return pivots, nodes.select("tree", F.col("x.h").alias("h"))


def _walk(pivots: list[DataFrame], tops: DataFrame, p: Params) -> DataFrame:
    """Paths of all leaves, from the top pivot down; ``tops`` has the path above each tree (tree, path)."""
    above, nodes = tops.select("tree", F.lit(0).cast("long").alias("block"), "path"), None
    for k in reversed(range(len(pivots))):
        nodes = _paths(pivots[k], above, k * p.levels, p)
        above = nodes.select("tree", F.col("i").alias("block"), "path")
    return nodes


def manifest(docs: DataFrame, also: Mapping[str, Column] | None = None, params: Params | None = None) -> DataFrame:
    """(doc_id, lang, place, leaf, path, subroot, root) for every row of documents, and the columns of ``also``.

    Rows become leaves (``leaf``). Per lang they ascend by doc_id (null first; rows of one doc_id by leaf, so equal
    rows are interchangeable), and while several nodes remain, every ``fanout`` consecutive ones become their hash,
    a shorter last run too, even of one. What remains is the lang's subroot; a lone leaf is its own. The subroots,
    ordered by lang (null first, then bytewise; the empty text is a lang of its own), give the root the same way.
    ``path`` holds the run's other nodes before and after the own one, level by level through the subroot to the
    root. An empty table gives an empty result. Only the named columns are read; clashing names do no harm.

    ``also`` names more expressions over the row that travel with it (such as the leaf of another version of it).
    """
    p, also = params or Params(), dict(also or {})
    lang = F.col("lang").cast("string")
    hashed = docs.select(
        F.when(lang.isNull(), "").otherwise(F.concat(F.lit(":"), lang)).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("h"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in also.items()]).alias("also"),
        # Written down with the rows: it keeps a block of equal rows from being one sort key.
        F.monotonically_increasing_id().alias("tie"),
    )
    leaves = settle(hashed, "leaves")
    laid = range_sorted(leaves, "tree", F.col("doc_id").asc_nulls_first(), "h", "tie")
    # One row per range partition and lang in it: what lies before it in its lang, and where it starts.
    parts = laid.groupBy("_part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = settle(parts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).drop("first"), "parts")
    trees = parts.groupBy("tree").agg(F.sum("n").alias("n"))
    trees = settle(dense_codes(trees.withColumn("all", F.lit("")), "all", "tree"), "trees")
    most = trees.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("trees")).first()

    sized = parts.select("_part", "tree", "offset").join(bounded(trees.select("tree", _height("n", p).alias("height"))), "tree")
    nodes = laid.join(bounded(sized), ["_part", "tree"]).select(
        "tree", "height", (F.col("_pos") + F.col("offset")).alias("i"), F.struct("h", "doc_id", "also").alias("x")
    )
    pivots, subroots = _grow(nodes, most["n"] or 1, p)
    discard(leaves)
    named = settle(trees.join(subroots, "tree").withColumnRenamed("h", "subroot"), "subroots")
    over = named.select(
        F.lit("").alias("tree"), _height(str(most["trees"]), p).alias("height"), F.col("code").cast("long").alias("i"),
        F.struct(F.col("subroot").alias("h"), F.col("tree").alias("of")).alias("x"),
    )
    top, root = _grow(over, most["trees"] or 1, p)
    none = F.expr(f"cast(array() as {PATH})").alias("path")
    tops = _walk(top, root.select("tree", none), p).select(F.col("x.of").alias("tree"), "path")
    tops = settle(tops.crossJoin(F.broadcast(root.select(F.col("h").alias("root")))), "tops")  # one row: the root
    ends = bounded(tops.join(named.select("tree", "subroot"), "tree").select("tree", "subroot", "root"))
    found = _walk(pivots, tops.select("tree", "path"), p).join(ends, "tree")
    return found.select(
        "x.doc_id", F.expr("if(tree = '', null, substring(tree, 2))").alias("lang"), F.col("i").alias("place"),
        F.col("x.h").alias("leaf"), "path", "subroot", "root", *[F.col("x.also")[name].alias(name) for name in also],
    )


def verify(docs: DataFrame, tampered: Mapping[str, Column], where: Column, params: Params | None = None) -> DataFrame:
    """Every row's proof, and whether it still leads to the root when the rows ``where`` holds have ``tampered`` values.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified); all but the last two are those of the
    untampered rows. A null condition leaves a row as it is.
    """
    changed = F.when(where, leaf(tampered)).otherwise(leaf())
    found = manifest(docs, {"now": changed}, params).withColumn("folded_root", fold(F.col("now"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
