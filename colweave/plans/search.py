"""Model selection: leaderboards, survivors, depth search, grid search.

Every fit is a Spark job over a cached split; the driver holds one row per fit.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colweave.functions.scalars import HASH_MODULUS, row_hash
from colweave.operators.score import auc_of_labels, neg_mse
from colweave.operators.split import FOLDS, INNER, TEST_SHARE, split_hash, with_fold
from colweave.plans.models import REGRESSION, Fitted, held, training_vectors
from colweave.schema import KEY, LABEL, col

# Searched depths, safety factor.
DEPTHS = list(range(2, 16))
REFIT_FACTOR = 3
SMALL_TIME = 1e-10

LEADERBOARD = "model string, score double, fit_rows_s bigint, predict_rows_s bigint"


def _score(scored: DataFrame, mode: str) -> float | None:
    """Higher is better: negative squared error, or the area under the curve of the labels."""
    return (neg_mse(scored) if mode == REGRESSION else auc_of_labels(scored)).first()[0]


def _timed_fit(estimator: Estimator, train: DataFrame, test: DataFrame, rows: tuple[int, int], mode: str):
    start = time.monotonic()
    model = Fitted(estimator.fit(train), ())
    fit_time = time.monotonic() - start
    start = time.monotonic()
    score = _score(model.predict_vectors(test), mode)
    predict_time = time.monotonic() - start
    return score, int(rows[0] / (fit_time + SMALL_TIME)), int(rows[1] / (predict_time + SMALL_TIME))


def leaderboard(candidates: Mapping[str, Estimator], df: DataFrame, names: Sequence[str], mode: str) -> DataFrame:
    """(model, score, fit_rows_s, predict_rows_s) of each candidate.

    A candidate is fitted on three quarters of the rows, chosen by key, and scored on the others, whatever their number.
    """
    found = []
    with held(df, names) as table:
        train, test = split_hash(table, salt=INNER)
        sizes = (train.count(), test.count())
        for name, estimator in candidates.items():
            found.append((name, *_timed_fit(estimator, train, test, sizes, mode)))
    return df.sparkSession.createDataFrame(found, LEADERBOARD)


def survivors(board: DataFrame) -> DataFrame:
    """Candidates at or above the mean score (equal scores all survive)."""
    mean = Window.partitionBy(F.lit(1))
    return board.withColumn("_mean", F.avg("score").over(mean)).where(F.col("score") >= F.col("_mean")).drop("_mean")


def winner(board: DataFrame) -> DataFrame:
    """The row with the highest score; by name among equals."""
    return board.orderBy(F.desc_nulls_last("score"), "model").limit(1)


def select_model(
    candidates: Mapping[str, Estimator], df: DataFrame, names: Sequence[str], mode: str,
    samples: Sequence[int] = (), total: int | None = None,
) -> tuple[str, DataFrame]:
    """Rounds on growing samples, then on all rows; after each, the candidates below the mean drop out.

    There are no samples unless the caller asks for them. About as many rows as asked for are drawn by a hash of the key,
    so a sample is no older or newer than the table.
    """
    left = dict(candidates)
    total = df.count() if samples and total is None else total
    board = None
    for rows in [n for n in samples if n < total] + [None]:
        drawn = df if rows is None else df.where(row_hash(col(KEY), FOLDS) < F.lit(int(HASH_MODULUS * rows / total)))
        board = leaderboard(left, drawn, names, mode)
        if rows is None:
            break
        kept = {r["model"] for r in survivors(board).collect()}
        left = {n: e for n, e in left.items() if n in kept}
        if len(left) <= 1:
            break
    return winner(board).first()["model"], board


def sample_rows(
    total: Column, fit_rows_s: Column, predict_rows_s: Column, seconds_left: Column, fits: int,
    test_share: float = TEST_SHARE,
) -> Column:
    """Rows per search step that fit a time budget after keeping time for the final fit."""
    left = seconds_left - F.lit(REFIT_FACTOR) * total / fit_rows_s
    per_row = F.lit(1 - test_share) / fit_rows_s + F.lit(test_share) / predict_rows_s
    rows = left / F.lit(fits) / per_row
    return F.greatest(F.least(rows, total.cast("double")).cast("bigint"), F.lit(0).cast("bigint"))


def sample_plan(board: DataFrame, total_rows: int | Column, seconds_left: float | Column, fits: int = len(DEPTHS)) -> DataFrame:
    """Add ``sample_rows`` to a table of measured speeds."""
    total = total_rows if isinstance(total_rows, Column) else F.lit(total_rows)
    left = seconds_left if isinstance(seconds_left, Column) else F.lit(float(seconds_left))
    return board.withColumn("sample_rows", sample_rows(total, F.col("fit_rows_s"), F.col("predict_rows_s"), left, fits))


def first_best(trials: DataFrame, step: str = "depth", score: str = "score") -> DataFrame:
    """The trial kept by the rule: go on while no score is worse than the one before.

    ``trials`` has one row per tried value. The row before the first drop wins,
    or the last row if there is none.
    """
    order = Window.partitionBy(F.lit(1)).orderBy(step)
    worse = F.coalesce((F.lag(score).over(order) > F.col(score)).cast("int"), F.lit(0))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    steady = trials.withColumn("_worse", worse).withColumn("_drops", F.sum("_worse").over(so_far))
    return steady.where(F.col("_drops") == 0).orderBy(F.desc(step)).limit(1).drop("_worse", "_drops")


def depth_search(
    estimator: Estimator, df: DataFrame, names: Sequence[str], mode: str, depths: Sequence[int] = tuple(DEPTHS),
    seconds: float | None = None, refit_factor: float = REFIT_FACTOR,
) -> tuple[Estimator, DataFrame]:
    """(estimator at the kept depth, table (depth, score, stopped_early) of the depths tried), always on all rows.

    With ``seconds`` the search ends once the time left would not hold another
    step like the last one and the final fit; the best so far is kept and the table says so.
    """
    began, stopped = time.monotonic(), False
    tried: list[tuple[int, float]] = []
    best = estimator
    with held(df, names) as table:
        train, test = split_hash(table, salt=INNER)
        for depth in depths:
            start = time.monotonic()
            trial = estimator.copy({estimator.maxDepth: depth})
            score = _score(Fitted(trial.fit(train), ()).predict_vectors(test), mode)
            # No score (one class only in the held-out part) ranks below any other.
            worse = bool(tried) and (score is None or (tried[-1][1] is not None and tried[-1][1] > score))
            tried.append((depth, score))
            if worse:
                break
            best = trial
            spent = time.monotonic() - start
            if seconds is not None and time.monotonic() - began + spent + refit_factor * spent > seconds:
                stopped = depth != depths[-1]
                break
    rows = [(depth, score, stopped) for depth, score in tried]
    return best, df.sparkSession.createDataFrame(rows, "depth int, score double, stopped_early boolean")


def grid_search(
    estimator: Estimator, grid: Mapping[str, Sequence], df: DataFrame, names: Sequence[str], mode: str,
    folds: int = 3, parallelism: int = 2,
) -> tuple[Fitted, DataFrame]:
    """Exhaustive search over a parameter grid, folds by key hash."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    points = builder.build()
    if mode == REGRESSION:
        metric = RegressionEvaluator(labelCol=LABEL, metricName="mse")
    else:
        metric = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    table = with_fold(training_vectors(df, names), folds).persist()
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=points, evaluator=metric, numFolds=folds, foldCol="fold",
        parallelism=parallelism,
    )
    fitted = search.fit(table)
    table.unpersist()
    sign = -1.0 if mode == REGRESSION else 1.0
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda i: i[0].name)), sign * float(m))
        for point, m in zip(points, fitted.avgMetrics, strict=True)
    ]
    return Fitted(fitted.bestModel, list(names)), df.sparkSession.createDataFrame(rows, "params string, score double")
