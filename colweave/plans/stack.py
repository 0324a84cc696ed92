"""Stacked models: families that did not see a row's fold score it, and a second fit weighs their scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.base import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave.operators.score import PREDICTION
from colweave.operators.split import with_fold
from colweave.plans.models import CLASSIFICATION, REGRESSION, Fitted, Shape, fit, logistic, training_vectors, vectors
from colweave.plans.ridge import Linear, ridge_grid
from colweave.schema import KEY, LABEL, col
from colweave.session import settle

FOLDS = 3


def column(name: str) -> str:
    """The column that holds a family's scores."""
    return f"score_{name}"


def _scored(df: DataFrame, models: Mapping[str, Fitted]) -> DataFrame:
    """Assembled rows with one score per family: the value, or the probability of class 1 where the family has one."""
    for name, fitted in models.items():
        out = fitted.model.transform(df)
        if "probability" in out.columns:
            value: Column = vector_to_array("probability")[1]
        elif "rawPrediction" in out.columns:
            # A margin, drawn into 0 to 1.
            value = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
        else:
            value = F.col("prediction")
        df = out.select(*[col(c) for c in df.columns], value.alias(column(name)))
    return df


def out_of_fold(
    families: Mapping[str, Estimator], df: DataFrame, names: Sequence[str], folds: int = FOLDS
) -> DataFrame:
    """(key, label, fold, one score column per family), every row scored by fits on the rows of the other folds.

    Folds go by key hash. A fold without rows costs no fit. All families score a fold in one projection, so the
    table is written once and no row is joined with another.
    """
    table = with_fold(training_vectors(df, names), folds).persist()
    parts = None
    for k in sorted(r["fold"] for r in table.select("fold").distinct().collect()):
        rest = table.where(F.col("fold") != k).persist()
        models = {n: Fitted(e.fit(rest), list(names)) for n, e in families.items()}
        rest.unpersist()
        own = settle(_scored(table.where(F.col("fold") == k), models).drop("features"), f"fold-{k}")
        parts = own if parts is None else parts.unionByName(own)
    table.unpersist()
    if parts is None:
        scores = ", ".join(f"`{column(n)}` double" for n in families)
        return df.sparkSession.createDataFrame([], f"{KEY} bigint, {LABEL} double, fold int, {scores}")
    return parts


@dataclass(frozen=True)
class Stacked:
    """Families fitted on all rows, and the fit that weighs their scores."""

    base: Mapping[str, Fitted]
    second: Linear | Fitted
    table: DataFrame  # the out-of-fold scores the second fit learned from

    def weights(self) -> dict[str, float]:
        """What each family counts for."""
        if isinstance(self.second, Linear):
            return dict(zip(self.base, self.second.weights, strict=True))
        return dict(zip(self.base, map(float, self.second.model.coefficients), strict=True))

    def predict(self, df: DataFrame) -> DataFrame:
        """(key, label if present, prediction): the value, or the probability of class 1. A projection."""
        first = next(iter(self.base.values()))
        scored = _scored(vectors(df, first.names), self.base).drop("features")
        if isinstance(self.second, Linear):
            return self.second.predict(scored)
        return self.second.predict(scored, probability=True).select(*[c for c in (KEY, LABEL) if c in df.columns], PREDICTION)


def fit_stacked(
    families: Mapping[str, Estimator], df: DataFrame, names: Sequence[str], mode: str, folds: int = FOLDS
) -> Stacked:
    """Fit the families on all rows, and a second fit on their out-of-fold scores.

    Regression: ridge over the scores, its penalty chosen by folds from one pass of sums. Classification: logistic
    regression over the probabilities. The second fit has as many features as there are families.
    """
    if mode not in (REGRESSION, CLASSIFICATION):
        raise ValueError(mode)
    table = out_of_fold(families, df, names, folds)
    columns = [column(n) for n in families]
    if mode == REGRESSION:
        second: Linear | Fitted = ridge_grid(table, columns, folds=folds)[0]
    else:
        second = fit(logistic(Shape.of(table, columns)), table, columns)
    base = {n: fit(e, df, names) for n, e in families.items()}
    return Stacked(base, second, table)
