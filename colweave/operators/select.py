"""Feature selection: correlation, variance, mutual information, principal components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colweave.operators.percolumn import per_column
from colweave.operators.profile import profile
from colweave.schema import LABEL, col, quoted

CORRELATION_LIMIT = 0.95
VARIANCE_LIMIT = 0.001
EXPLAINED_LIMIT = 0.99
# Bytes of one block of sums, blocks that a task adds up at a time, and bytes of the rows it multiplies at once.
SUMS_BYTES = 64 << 20
BLOCKS_PER_PASS = 4
BATCH_BYTES = 16 << 20
ROUNDING = 1e-13


def blob_sums(parts: DataFrame, spread: int = 32) -> DataFrame:
    """(block, sums): arrays of doubles added up per block, in two steps so that no task adds up all of them."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                found = np.frombuffer(raw)
                total[block] = total[block] + found if block in total else found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            names=["block", "sums"],
        )

    kind = "block int, sums binary"
    dealt = parts.withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(spread))).repartition(spread, "block", "bucket")
    first = dealt.drop("bucket").mapInArrow(add, kind)
    return first.repartition("block").mapInArrow(add, kind)


def pair_correlations(df: DataFrame, left: Sequence[str], right: Sequence[str] | None = None) -> np.ndarray:
    """Pearson r of each left with each right column (default: the left ones); missing values left out pair by pair.

    NaN where a side does not vary. Every task adds up products of whole Arrow
    batches: one pass over the table whatever the number of pairs (until the
    sums outgrow a task, at some thousand columns). Columns are shifted by their means first, for precision.
    """
    left = list(left)
    right = left if right is None else list(right)
    names = list(dict.fromkeys([*left, *right]))
    if not left or not right:
        return np.zeros((len(left), len(right)))
    ends = profile(df, names, sketch=False)
    shift = np.array([ends[n].mean if ends[n].mean is not None else 0.0 for n in names], float)
    at = {n: i for i, n in enumerate(names)}
    a, b = np.array([at[n] for n in left]), np.array([at[n] for n in right])
    plain = df.selectExpr(*[f"cast({quoted(n)} as double) as _f{i}" for i, n in enumerate(names)])
    wide = max(1, SUMS_BYTES // (6 * 8 * len(b)))
    blocks = [a[i : i + wide] for i in range(0, len(a), wide)]
    rows = max(1, BATCH_BYTES // (8 * len(names)))

    def products(chosen: dict[int, np.ndarray]):  # noqa: ANN202
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {block: np.zeros((6, len(c), len(b))) for block, c in chosen.items()}
            for batch in batches:
                for start in range(0, batch.num_rows, rows):
                    part = batch.slice(start, rows)
                    x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], 1).astype(float) - shift
                    filled = np.isfinite(x)
                    x, m = np.where(filled, x, 0.0), filled.astype(float)
                    for block, c in chosen.items():
                        xa, ma, xb, mb = x[:, c].T, m[:, c].T, x[:, b], m[:, b]
                        total[block] += np.stack([ma @ mb, xa @ mb, ma @ xb, (xa * xa) @ mb, ma @ (xb * xb), xa @ xb])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                names=["block", "sums"],
            )

        return run

    found = np.zeros((6, len(a), len(b)))
    for first in range(0, len(blocks), BLOCKS_PER_PASS):
        chosen = dict(enumerate(blocks[first : first + BLOCKS_PER_PASS], first))
        for row in blob_sums(plain.mapInArrow(products(chosen), "block int, sums binary")).toLocalIterator():
            part = np.frombuffer(row["sums"]).reshape(6, -1, len(b))
            found[:, row["block"] * wide : row["block"] * wide + part.shape[1]] += part
    n, sx, sy, sxx, syy, sxy = found
    with np.errstate(divide="ignore", invalid="ignore"):
        mx, my = sx / n, sy / n
        vx, vy = sxx / n - mx * mx, syy / n - my * my
        # Below the rounding of the shifted sums a side counts as constant.
        still = (vx <= ROUNDING * (sxx / n + shift[a][:, None] ** 2 * ROUNDING)) | (vy <= ROUNDING * (syy / n + shift[b] ** 2 * ROUNDING))
        return np.where(still, np.nan, (sxy / n - mx * my) / np.sqrt(vx * vy))


def assemble(df: DataFrame, names: Sequence[str], out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and one vector; feature names may hold any character."""
    plain = [f"_f{i}" for i in range(len(names))]
    doubles = [f"cast({quoted(n)} as double) as {p}" for n, p in zip(names, plain, strict=True)]
    safe = df.selectExpr(*[quoted(k) for k in keep], *doubles)
    return VectorAssembler(inputCols=plain, outputCol=out).transform(safe).drop(*plain)


def correlation_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long form (column_i, column_j, r) with i before j; missing values pair by pair, null where a side does not vary."""
    names = list(names)
    r = pair_correlations(df, names)
    i, j = np.triu_indices(len(names), 1)
    label, values = pa.array(names, pa.string()), r[i, j]
    long = pa.table({
        "column_i": label.take(pa.array(i)), "column_j": label.take(pa.array(j)), "r": pa.array(values, mask=np.isnan(values)),
    })
    return df.sparkSession.createDataFrame(long)


def correlated_columns(df: DataFrame, names: Sequence[str], limit: float = CORRELATION_LIMIT) -> list[str]:
    """The later column of every pair above the limit, also when the earlier one is dropped too."""
    r = np.nan_to_num(np.abs(pair_correlations(df, names)))
    late = np.triu(r > limit, 1).any(0) if len(names) else ()
    return [n for n, gone in zip(names, late, strict=True) if gone]


def target_correlations(df: DataFrame, names: Sequence[str], label: str = LABEL) -> DataFrame:
    """(column, abs_corr) with the label; null for a column that does not vary."""
    r = pair_correlations(df, names, [label])[:, 0]
    out = [(n, None if np.isnan(v) else float(abs(v))) for n, v in zip(names, r, strict=True)]
    return df.sparkSession.createDataFrame(out, "column string, abs_corr double")


def columns_within(width: int, size_bytes: int, limit_bytes: int) -> int:
    """How many of ``width`` columns shrink a table of ``size_bytes`` to the limit; what a caller may pass as ``k``."""
    return min(width, int(width / (size_bytes / limit_bytes))) if size_bytes else width


def top_by_target(
    df: DataFrame, names: Sequence[str], k: int, label: str = LABEL
) -> DataFrame:
    """The ``k`` columns most correlated with the label; see ``columns_within``."""
    ranked = target_correlations(df, names, label)
    return ranked.orderBy(F.desc_nulls_last("abs_corr"), "column").limit(k)


def variances(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, variance), population form."""
    found, _ = per_column(df, names, {"v": "var_pop({v})"})
    return df.sparkSession.createDataFrame([(n, v["v"]) for n, v in found.items()], "column string, variance double")


def varying_columns(df: DataFrame, names: Sequence[str], limit: float = VARIANCE_LIMIT) -> list[str]:
    kept = {r["column"] for r in variances(df, names).where(F.col("variance") > F.lit(limit)).collect()}
    return [n for n in names if n in kept]


def mutual_information(
    df: DataFrame, names: Sequence[str], label: str = LABEL, bins: int = 16, accuracy: int = 10_000
) -> DataFrame:
    """(column, mi) in nats between each column and the label, on bins of equally many rows.

    Equal-width bins would put nearly all rows into one as soon as a single
    value lies far out. One pass finds the cuts of all columns by quantile
    sketches, one groups; its result holds at most bins x bins
    rows per column, and map-side combining leaves next to nothing to shuffle.
    """
    shares = [k / bins for k in range(1, bins)]
    columns = list(dict.fromkeys([*names, label]))
    cuts = df.agg(*[F.percentile_approx(col(n).cast("double"), shares, accuracy).alias(f"c{i}") for i, n in enumerate(columns)]).first()

    def bin_of(n: str) -> Column:
        """How many cuts lie below the value."""
        points = sorted(set(cuts[f"c{columns.index(n)}"] or ()))
        below = F.filter(F.array(*[F.lit(float(c)) for c in points]), lambda c: c < col(n).cast("double")) if points else F.array()
        return F.when(col(n).isNotNull(), F.size(below).cast("bigint"))

    pairs = F.array(*[F.struct(F.lit(n).alias("column"), bin_of(n).alias("bx")) for n in names])
    long = df.select(bin_of(label).alias("by"), F.inline(pairs)).where(F.col("bx").isNotNull() & F.col("by").isNotNull())
    joint = long.groupBy("column", "bx", "by").agg(F.count(F.lit(1)).alias("n"))
    # at most bins x bins rows per column from here on
    whole, of_x, of_y = Window.partitionBy("column"), Window.partitionBy("column", "bx"), Window.partitionBy("column", "by")
    share = joint.select(
        "column",
        (F.col("n") / F.sum("n").over(whole)).alias("p"),
        (F.sum("n").over(of_x) / F.sum("n").over(whole)).alias("px"),
        (F.sum("n").over(of_y) / F.sum("n").over(whole)).alias("py"),
    )
    return share.groupBy("column").agg(F.sum(F.col("p") * F.log(F.col("p") / (F.col("px") * F.col("py")))).alias("mi"))


def above_spread(table: DataFrame, value: str = "mi", deviations: float = 0.0) -> DataFrame:
    """Rows whose value exceeds mean + k * population deviation over the (small) table."""
    all_rows = Window.partitionBy(F.lit(1))
    limit = F.avg(value).over(all_rows) + F.lit(deviations) * F.stddev_pop(value).over(all_rows)
    return table.withColumn("_limit", limit).where(F.col(value) > F.col("_limit")).drop("_limit")


@dataclass(frozen=True)
class Components:
    """Explained shares of the principal components and how many pass the limit."""

    model: object
    ratios: tuple[float, ...]
    count: int

    def table(self, spark) -> DataFrame:
        total, rows = 0.0, []
        for i, share in enumerate(self.ratios, 1):
            total += share
            rows.append((i, share, total, i <= self.count))
        return spark.createDataFrame(rows, "component int, ratio double, cumulative double, kept boolean")


def principal_components(df: DataFrame, names: Sequence[str], limit: float = EXPLAINED_LIMIT) -> Components:
    """Smallest number of components whose cumulative share of variance passes the limit."""
    fitted = PCA(k=len(names), inputCol="features", outputCol="components").fit(assemble(df, names))
    ratios = tuple(float(v) for v in fitted.explainedVariance.toArray())
    total, count = 0.0, 0
    for share in ratios:
        total += share
        count += 1
        if total > limit:
            break
    return Components(fitted, ratios, count)
