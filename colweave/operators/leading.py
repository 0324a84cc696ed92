"""Leading principal components of wide tables, without the matrix of all pairs of columns.

A pass over the table multiplies its covariance by a few vectors: every task adds up width x vectors numbers, and
nothing else leaves it. Passes span a Krylov space, in which the components are found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.select import BATCH_BYTES, EXPLAINED_LIMIT, blob_sums
from colweave.schema import KEY, col, quoted


@dataclass(frozen=True)
class Leading:
    """Components (one column of ``vectors`` each) with their shares of the variance, the largest first.

    Every share is within ``error`` of a true one; ``reached`` says whether the shares asked for were all found.
    """

    names: tuple[str, ...]
    means: np.ndarray
    vectors: np.ndarray
    ratios: tuple[float, ...]
    error: float
    passes: int
    reached: bool

    def table(self, spark) -> DataFrame:
        rows = [(i, float(r), float(c)) for i, (r, c) in enumerate(zip(self.ratios, np.cumsum(self.ratios), strict=True), 1)]
        return spark.createDataFrame(rows, "component int, ratio double, cumulative double")

    def apply(self, df: DataFrame, prefix: str = "number_component_", key: str = KEY) -> DataFrame:
        """(key, one column per component): the centred row on each component; missing values count as the mean."""
        means, vectors, step = self.means, self.vectors, max(1, BATCH_BYTES // (8 * len(self.names)))
        names = [key, *[f"{prefix}{i}" for i in range(1, vectors.shape[1] + 1)]]

        def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    x = _centred(part.columns[1:], means) @ vectors
                    yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c) for c in x.T]], names=names)

        kind = f"{quoted(key)} {df.select(col(key)).schema[0].dataType.simpleString()}, " + ", ".join(f"{quoted(n)} double" for n in names[1:])
        return df.select(col(key), *_doubles(self.names)).mapInArrow(project, kind)


def _doubles(names: Sequence[str]) -> list:
    return [F.expr(f"cast({quoted(n)} as double) as _f{i}") for i, n in enumerate(names)]


def _centred(columns: Sequence[pa.Array], means: np.ndarray) -> np.ndarray:
    x = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], 1).astype(float) - means
    return np.where(np.isfinite(x), x, 0.0)


def _means(plain: DataFrame, width: int) -> np.ndarray:
    """Mean of the finite values of every column (0 without any), as sums over Arrow batches."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width))
        for batch in batches:
            for i, c in enumerate(batch.columns):
                x = c.to_numpy(zero_copy_only=False).astype(float)
                finite = np.isfinite(x)
                total[:, i] += finite.sum(), x[finite].sum()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])

    found = blob_sums(plain.mapInArrow(add, "block int, sums binary")).collect()
    n, total = np.frombuffer(found[0]["sums"]).reshape(2, width) if found else np.zeros((2, width))
    return total / np.maximum(n, 1)


def _times_covariance(plain: DataFrame, means: np.ndarray, block: np.ndarray, squares: bool) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sum of squares per column, X'X block) of the centred table X: one pass."""
    width, step = block.shape[0], max(1, BATCH_BYTES // (8 * block.shape[0]))

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, square, total = 0, np.zeros(width), np.zeros(block.shape)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                x = _centred(batch.slice(start, step).columns, means)
                rows += len(x)
                total += x.T @ (x @ block)
                if squares:
                    square += (x * x).sum(0)
        packed = np.concatenate([[float(rows)], square, total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([packed.tobytes()], pa.binary())], names=["block", "sums"])

    found = blob_sums(plain.mapInArrow(products, "block int, sums binary")).collect()
    sums = np.frombuffer(found[0]["sums"]) if found else np.zeros(1 + width + block.size)
    return int(sums[0]), sums[1 : 1 + width], sums[1 + width :].reshape(block.shape)


def leading_components(
    df: DataFrame, names: Sequence[str], k: int | None = None, limit: float = EXPLAINED_LIMIT, block: int = 16,
    tolerance: float = 1e-7, passes: int = 40, seed: int = 0,
) -> Leading:
    """The ``k`` components of most variance, or (``k`` None) the fewest whose shares add up to over ``limit``.

    Starts with ``block`` random vectors. Every pass multiplies the newest vectors by the covariance; what is new in
    the result, found with Gram matrices of the vectors so far, goes into the next pass. The components of the
    space so far are those of a matrix as small as the number of its vectors. It ends when every component asked for
    moves by less than ``tolerance`` of the whole variance if multiplied once more (which bounds the error of its
    share), when the space holds all columns (then it is exact), or after ``passes``.

    The driver holds width x block x passes numbers; tasks hold width x block and a few rows. Missing values count
    as the mean of their column. An empty table, or one that does not vary, has no components.
    """
    names = list(names)
    width = len(names)
    none = Leading(tuple(names), np.zeros(width), np.zeros((width, 0)), (), 0.0, 0, True)
    if not names or (k is not None and k < 1):
        return none
    plain = df.select(*_doubles(names))
    means = _means(plain, width)
    rng = np.random.default_rng(seed)
    newest = np.linalg.qr(rng.standard_normal((width, min(block, width))))[0]
    space, image, variance, found = np.zeros((width, 0)), np.zeros((width, 0)), 0.0, none
    for done in range(1, passes + 1):
        rows, squares, product = _times_covariance(plain, means, newest, done == 1)
        if done == 1:
            variance = float(squares.sum())
            if rows < 2 or variance <= 0:
                return none
        space, image = np.hstack([space, newest]), np.hstack([image, product / variance])
        small = space.T @ image
        shares, turn = np.linalg.eigh((small + small.T) / 2)
        shares, turn = np.maximum(shares[::-1], 0.0), turn[:, ::-1]
        vectors = space @ turn
        errors = np.linalg.norm(image @ turn - vectors * shares, axis=0)
        whole = space.shape[1] >= width
        over = np.flatnonzero(np.cumsum(shares) > limit)
        wanted = min(k, width) if k is not None else (int(over[0]) + 1 if len(over) else width)
        at_hand = min(wanted, len(shares))
        error = float(errors[:at_hand].max())
        reached = whole or (wanted <= len(shares) and error < tolerance)
        found = Leading(tuple(names), means, vectors[:, :at_hand], tuple(map(float, shares[:at_hand])), error, done, reached)
        if reached:
            break
        # Twice: what rounding leaves of the old vectors goes with the second subtraction.
        fresh = product / variance
        for _ in range(2):
            fresh = fresh - space @ (space.T @ fresh)
        left, sizes, _ = np.linalg.svd(fresh, full_matrices=False)
        newest = left[:, sizes > 1e-13][:, : width - space.shape[1]]
        if not newest.shape[1]:
            # The space is closed under the covariance: what is outside was not met by the random start.
            extra = rng.standard_normal((width, min(block, width - space.shape[1])))
            for _ in range(2):
                extra = extra - space @ (space.T @ extra)
            newest = np.linalg.qr(extra)[0]
        else:
            for _ in range(2):
                newest = newest - space @ (space.T @ newest)
                newest = np.linalg.qr(newest)[0]
    return found
