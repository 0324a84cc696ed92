"""Model candidates as Spark ML estimators, fitting and prediction."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.score import PREDICTION
from colweave.operators.select import assemble
from colweave.schema import KEY, LABEL, col

REGRESSION = "regression"
CLASSIFICATION = "classification"
FEATURES = "features"
NORMAL_SOLVER_WIDTH = 4096
# Bytes of feature values that one task of a fit holds, and rows below which another task costs more than it saves.
TASK_BYTES = 32 << 20
TASK_ROWS = 20_000

# Parameters of the slow-learning boosted candidate that Spark ML has a name for.
SLOW_BOOST = {
    "stepSize": 0.01, "subsamplingRate": 0.70, "featureSubsetStrategy": "0.7", "minInstancesPerNode": 10, "maxDepth": 8,
}
# Parameters of the fast-learning boosted candidate.
FAST_BOOST = {"stepSize": 0.1, "maxDepth": 3}
BOOST_ROUNDS = 100
SEED = 42


@dataclass(frozen=True)
class Shape:
    """What an estimator's parameters may depend on."""

    rows: int
    width: int = 0
    label_deviation: float = 1.0

    @classmethod
    def of(cls, df: DataFrame, names: Sequence[str]) -> Shape:
        row = df.agg(F.count(F.lit(1)), F.stddev_pop(F.col(LABEL).cast("double"))).first()
        return cls(row[0], len(names), row[1] or 1.0)


def ridge(shape: Shape, alpha: float = 1.0) -> Estimator:
    """Squared error sum plus alpha * |w|^2.

    Spark minimises half the mean error of a label divided by its deviation,
    so its penalty is alpha * deviation / rows.
    """
    return LinearRegression(
        labelCol=LABEL, elasticNetParam=0.0, regParam=alpha * shape.label_deviation / shape.rows,
        standardization=False, solver="normal" if shape.width <= NORMAL_SOLVER_WIDTH else "l-bfgs",
    )


def logistic(shape: Shape, c: float = 1.0, rounds: int = 100) -> Estimator:
    """Logistic loss sum plus |w|^2 / (2 c)."""
    return LogisticRegression(
        labelCol=LABEL, elasticNetParam=0.0, regParam=1.0 / (c * shape.rows), standardization=False, maxIter=rounds
    )


def boosted(mode: str, rounds: int = BOOST_ROUNDS, slow: bool = False, **params) -> Estimator:
    kind = GBTRegressor if mode == REGRESSION else GBTClassifier
    return kind(labelCol=LABEL, maxIter=rounds, seed=SEED, **{**(SLOW_BOOST if slow else FAST_BOOST), **params})


def forest(mode: str, trees: int = 20, **params) -> Estimator:
    kind = RandomForestRegressor if mode == REGRESSION else RandomForestClassifier
    return kind(labelCol=LABEL, numTrees=trees, seed=SEED, **params)


def linear_svm(shape: Shape, c: float = 1.0, rounds: int = 50) -> Estimator:
    return LinearSVC(labelCol=LABEL, regParam=1.0 / (c * shape.rows), maxIter=rounds)


def linear(mode: str, shape: Shape) -> Estimator:
    return ridge(shape) if mode == REGRESSION else logistic(shape)


def boosted_pair(mode: str, rounds: int = BOOST_ROUNDS) -> dict[str, Estimator]:
    """The two candidates every search starts from."""
    return {"boost_fast": boosted(mode, rounds), "boost_slow": boosted(mode, rounds, slow=True)}


def all_families(mode: str, shape: Shape) -> dict[str, Estimator]:
    """Candidates of the automatic search, one or more per model family, each with all its rounds."""
    out = {"linear": linear(mode, shape), "forest": forest(mode), **boosted_pair(mode)}
    if mode == CLASSIFICATION:
        out["linear_svm"] = linear_svm(shape)
    return out


def vectors(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(key, label if present, features): all a fit or a prediction needs."""
    keep = [c for c in (KEY, LABEL) if c in df.columns]
    out = assemble(df, names, FEATURES, keep)
    return out.withColumn(LABEL, F.col(LABEL).cast("double")) if LABEL in keep else out


def fit_tasks(rows: int, width: int, cores: int) -> int:
    """Tasks of a pass over a training table: one per ``TASK_BYTES``, at least one per core unless they would be tiny."""
    return max(-(-rows * 8 * (width + 2) // TASK_BYTES), min(cores, rows // TASK_ROWS), 1)


def training_vectors(df: DataFrame, names: Sequence[str], rows: int | None = None) -> DataFrame:
    """``vectors`` dealt evenly over as many tasks as their size asks for.

    A solver passes over its table some hundred times, so the layout of the source counts: a join leaves many tiny parts,
    a scan few large ones. Rows go by the hash of key, label and some features, which gives a lost task the same rows again.
    """
    rows = df.count() if rows is None else rows
    keep = [c for c in (KEY, LABEL) if c in df.columns]
    tasks = fit_tasks(rows, len(names), df.sparkSession.sparkContext.defaultParallelism)
    if is_dealt(df):
        return df.repartition(tasks, *[col(c) for c in keep])
    by = [col(c) for c in [*keep, *names[:4]]]
    return vectors(df.select(*[col(c) for c in [*keep, *names]]).repartition(tasks, *by), names)


def is_dealt(df: DataFrame) -> bool:
    """Whether a table is one of ``training_vectors``, or rows of one."""
    return set(df.columns) <= {KEY, LABEL, FEATURES} and FEATURES in df.columns and isinstance(df.schema[FEATURES].dataType, VectorUDT)


@contextmanager
def held(df: DataFrame, names: Sequence[str], rows: int | None = None) -> Iterator[DataFrame]:
    """``training_vectors`` in memory or on disk for the passes of the solvers.

    Steps that share a table deal it once: what is held already goes on as it is, and its owner lets it go.
    """
    if is_dealt(df) and df.is_cached:
        yield df
        return
    table = training_vectors(df, names, rows).persist()
    try:
        yield table
    finally:
        table.unpersist()


@dataclass(frozen=True)
class Fitted:
    """A fitted Spark ML model with the feature columns it reads, in order."""

    model: Model
    names: Sequence[str]

    def predict(self, df: DataFrame, probability: bool = False) -> DataFrame:
        """(key, label if present, prediction): the value, the label, or the probability of class 1."""
        return self.predict_vectors(vectors(df, self.names), probability)

    def described(self) -> dict[str, str]:
        """The method and its parameters as JSON, for run metrics."""
        given = {p.name: v for p, v in self.model.extractParamMap().items()}
        return {"method": type(self.model).__name__, "parameters": json.dumps(given, default=str, sort_keys=True)}

    def predict_vectors(self, df: DataFrame, probability: bool = False) -> DataFrame:
        keep = [c for c in (KEY, LABEL) if c in df.columns]
        scored = self.model.transform(df)
        value = vector_to_array("probability")[1] if probability else F.col("prediction")
        return scored.select(*keep, value.alias(PREDICTION))


def fit(estimator: Estimator, df: DataFrame, names: Sequence[str], rows: int | None = None) -> Fitted:
    """Fit on the assembled table, held in memory or on disk for the passes of the solver. ``rows`` saves counting it."""
    with held(df, names, rows) as table:
        return Fitted(estimator.fit(table), list(names))
