"""What a fitted model learnt: feature importances, feature responses, error per boosting round."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.scale import Scaler
from colweave.plans.models import Fitted, vectors
from colweave.schema import LABEL


# Each feature adds two copies of a row's vector while they are scored.
FEATURES_AT_A_TIME = 4


def importances(fitted: Fitted, spark) -> DataFrame:
    """(feature, importance); coefficients' size for a linear model."""
    if hasattr(fitted.model, "featureImportances"):
        values = fitted.model.featureImportances.toArray()
    else:
        values = abs(fitted.model.coefficients.toArray())
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(fitted.names, values, strict=True)], "feature string, importance double"
    )


def responses(fitted: Fitted, df: DataFrame, features: Sequence[str], half: Mapping[str, float] | None = None) -> DataFrame:
    """How the prediction moves when one feature goes down or up by half its deviation.

    (feature, delta, fr_dec, fr_inc, frd_abs, fri_abs, frd_mad, fri_mad): mean
    change, mean and median size of the change. A linear model's responses
    follow from its coefficients, and a feature that no tree splits on has
    none. For the others, a few features at a time, every row is scored in its
    own task for all their shifts; only sums and quantile sketches are shuffled.
    """
    if half is None:
        stats = Scaler.fit(df, features).stats
        half = {n: (stats[n][1] or 0.0) / 2 for n in features}
    position = {n: i for i, n in enumerate(fitted.names)}
    still = {}
    if isinstance(fitted.model, LinearRegressionModel):
        still = {n: float(fitted.model.coefficients[position[n]]) * half[n] for n in features}
    elif hasattr(fitted.model, "featureImportances"):
        weights = fitted.model.featureImportances
        still = {n: 0.0 for n in features if weights[position[n]] == 0.0}
    kind = "feature string, fr_dec double, fr_inc double, frd_abs double, fri_abs double, frd_mad double, fri_mad double, delta double"
    rows = [(n, -c, c, abs(c), abs(c), abs(c), abs(c), float(half[n])) for n, c in still.items()]
    table = df.sparkSession.createDataFrame(rows, kind)
    moving = [n for n in features if n not in still]
    for i in range(0, len(moving), FEATURES_AT_A_TIME):
        table = table.unionByName(_moved(fitted, df, moving[i : i + FEATURES_AT_A_TIME], half, position))
    return table


def _moved(
    fitted: Fitted, df: DataFrame, features: Sequence[str], half: Mapping[str, float], position: Mapping[str, int]
) -> DataFrame:
    """Responses of a few features, by scoring every row once per shift."""
    base = fitted.model.transform(vectors(df, fitted.names)).select(
        vector_to_array("features").alias("_x"), F.col("prediction").alias("_base")
    )
    shifts = F.array(*[
        F.struct(
            F.lit(n).alias("feature"), F.lit(position[n]).alias("_at"), F.lit(sign * half[n]).alias("_by"),
            F.lit(sign > 0).alias("_up"),
        )
        for n in features for sign in (-1.0, 1.0)
    ])
    moved = base.select("_x", "_base", F.inline(shifts)).select(
        "feature", "_up", "_base",
        array_to_vector(F.transform("_x", lambda v, i: F.when(i == F.col("_at"), v + F.col("_by")).otherwise(v))).alias("features"),
    )
    change = fitted.model.transform(moved).select(
        "feature", "_up", (F.col("prediction") - F.col("_base")).alias("_change")
    )
    down, up = F.when(~F.col("_up"), F.col("_change")), F.when(F.col("_up"), F.col("_change"))
    table = change.groupBy("feature").agg(
        F.avg(down).alias("fr_dec"), F.avg(up).alias("fr_inc"),
        F.avg(F.abs(down)).alias("frd_abs"), F.avg(F.abs(up)).alias("fri_abs"),
        F.percentile_approx(F.abs(down), 0.5).alias("frd_mad"), F.percentile_approx(F.abs(up), 0.5).alias("fri_mad"),
    )
    deltas = df.sparkSession.createDataFrame([(n, float(half[n])) for n in features], "feature string, delta double")
    return table.join(F.broadcast(deltas), "feature")


def feature_table(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Importance of every feature, with responses for the number columns only."""
    numbers = [n for n in fitted.names if n.startswith("number")]
    weights = importances(fitted, df.sparkSession)
    return weights.join(F.broadcast(responses(fitted, df, numbers)), "feature", "left") if numbers else weights


def boost_curve(fitted: Fitted, df: DataFrame) -> DataFrame:
    """(iter, rmse) on ``df`` after each boosting round."""
    errors = fitted.model.evaluateEachIteration(vectors(df, fitted.names).select("features", LABEL), "squared")
    rows = [(i, float(e)) for i, e in enumerate(errors)]
    return df.sparkSession.createDataFrame(rows, "iter int, mse double").select("iter", F.sqrt("mse").alias("rmse"))
