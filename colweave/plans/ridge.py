"""Ridge regression over all penalties and folds from one pass of sums.

Squared error needs of the rows only the products of the columns. With one set
of sums per fold, the rows outside a fold are the total minus the fold, and the
error on the fold follows from its own sums: no penalty and no fold costs
another pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.score import PREDICTION
from colweave.operators.select import BATCH_BYTES, blob_sums
from colweave.operators.split import with_fold
from colweave.schema import KEY, LABEL, literal, quoted

# The penalties of the usual search.
ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)
MOST_FEATURES = 4096


@dataclass(frozen=True)
class Linear:
    """Weights per column and an intercept; a prediction is a projection."""

    names: Sequence[str]
    weights: Sequence[float]
    intercept: float
    alpha: float

    def predict(self, df: DataFrame) -> DataFrame:
        """(key, label if present, prediction); null where a feature is."""
        terms = [f"{literal(float(w))} * cast({quoted(n)} as double)" for n, w in zip(self.names, self.weights, strict=True)]
        keep = [quoted(c) for c in (KEY, LABEL) if c in df.columns]
        return df.selectExpr(*keep, f"{' + '.join([literal(float(self.intercept)), *terms])} as {PREDICTION}")


@dataclass(frozen=True)
class Sums:
    """Products of (1, features, label), shifted by ``shift``, per fold: array fold x (width + 2) x (width + 2)."""

    names: Sequence[str]
    shift: np.ndarray
    products: np.ndarray

    def fit(self, products: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
        """(weights, intercept) of least sum of squared errors plus alpha |w|^2; the intercept, in shifted columns, is free."""
        n, width = products[0, 0], len(self.names)
        if not n:
            return np.zeros(width), 0.0
        mean = products[0, 1:] / n
        centred = products[1:, 1:] - n * np.outer(mean, mean)
        xx, xy = centred[:width, :width], centred[:width, width]
        w = np.linalg.lstsq(xx + alpha * np.eye(width), xy, rcond=None)[0] if width else np.zeros(0)
        return w, float(mean[width] - mean[:width] @ w)

    def error(self, products: np.ndarray, w: np.ndarray, intercept: float) -> float:
        """Sum of squared errors of a fit on the rows behind some products."""
        v = np.concatenate([[-intercept], -w, [1.0]])
        return float(max(0.0, v @ products @ v))

    def linear(self, alpha: float) -> Linear:
        """The fit on all rows."""
        w, intercept = self.fit(self.products.sum(0), alpha)
        return Linear(self.names, [float(x) for x in w], float(intercept + self.shift[-1] - self.shift[:-1] @ w), alpha)


def fold_sums(df: DataFrame, names: Sequence[str], folds: int) -> Sums:
    """One pass: every task adds up products of whole Arrow batches per fold.

    Rows with a missing feature, label or key count nowhere. Columns are shifted by the first such row for precision.
    """
    names = list(names)
    if len(names) > MOST_FEATURES:
        raise ValueError(f"{len(names)} features: the products of over {MOST_FEATURES} do not fit a task")
    size = len(names) + 2
    doubles = [f"cast({quoted(n)} as double) as _f{i}" for i, n in enumerate([*names, LABEL])]
    usable = " and ".join(f"abs(_f{i}) < cast('inf' as double)" for i in range(size - 1))
    plain = with_fold(df.selectExpr(quoted(KEY), *doubles).where(usable).where(F.col(KEY).isNotNull()), folds).drop(KEY)
    first = plain.drop("fold").limit(1).collect()
    shift = np.array(first[0] if first else [0.0] * (size - 1), float)
    step = max(1, BATCH_BYTES // (8 * size))

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns[:-1]], 1).astype(float) - shift
                x = np.concatenate([np.ones((len(x), 1)), x], 1)
                fold = part.column("fold").to_numpy(zero_copy_only=False)
                for k in np.unique(fold).tolist():
                    own = x[fold == k]
                    total[k] = total.get(k, 0) + own.T @ own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["block", "sums"]
        )

    out = np.zeros((folds, size, size))
    for row in blob_sums(plain.mapInArrow(products, "block int, sums binary")).toLocalIterator():
        out[row["block"]] = np.frombuffer(row["sums"]).reshape(size, size)
    return Sums(names, shift, out)


def ridge_grid(
    df: DataFrame, names: Sequence[str], alphas: Sequence[float] = ALPHAS, folds: int = 3
) -> tuple[Linear, DataFrame]:
    """(fit on all rows at the best penalty, table (alpha, fold, rows, mse, weights and intercept of the fit without the fold)).

    Every penalty is judged by the mean over the folds of the mean squared error on rows that its fit did not see; the
    largest of the best wins. Folds go by key hash; empty ones have no error and do not count. The penalty is
    alpha |w|^2 beside the sum of squared errors; the intercept is free.
    """
    sums = fold_sums(df, names, folds)
    total = sums.products.sum(0)
    rows, score = [], {}
    for alpha in alphas:
        errors = []
        for k, own in enumerate(sums.products):
            w, intercept = sums.fit(total - own, alpha)
            n = int(round(own[0, 0]))
            mse = sums.error(own, w, intercept) / n if n else None
            errors += [mse] if n else []
            plain = float(intercept + sums.shift[-1] - sums.shift[:-1] @ w)
            rows.append((float(alpha), k, n, mse, [float(x) for x in w], plain))
        score[alpha] = float(np.mean(errors)) if errors else float("inf")
    best = min(score, key=lambda a: (score[a], -a))
    kind = "alpha double, fold int, rows bigint, mse double, weights array<double>, intercept double"
    return sums.linear(best), df.sparkSession.createDataFrame(rows, kind)
