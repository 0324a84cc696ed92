import numpy as np
import pytest
from pyspark.sql import functions as F

from colweave.operators.split import with_fold
from colweave.plans import models
from colweave.plans.ridge import Linear, fold_sums, ridge_grid

NAMES = ["number_0", "number_1", "number_2"]


def frame(spark, n=400, seed=1, far=0.0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 3)) * [1, 10, 0.1] + [far, 0, 5]
    y = x @ [2.0, -0.3, 7.0] + 0.5 * rng.standard_normal(n) + 3
    rows = [(k * 7 + 1, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "line_id long, number_0 double, number_1 double, number_2 double, target double")


def refit(x, y, alpha):
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return w, my - mx @ w


@pytest.mark.parametrize("far", [0.0, 1e6])
def test_every_cell_equals_a_refit_without_its_fold(spark, far):
    df = frame(spark, far=far)
    alphas, folds = (0.01, 1.0, 300.0), 4
    best, table = ridge_grid(df, NAMES, alphas, folds)
    pdf = with_fold(df, folds).toPandas()
    errors = {}
    for r in table.collect():
        own = pdf.fold == r.fold
        x, y = pdf[NAMES].to_numpy(), pdf.target.to_numpy()
        w, b = refit(x[~own], y[~own], r.alpha)
        mse = float(((y[own] - x[own] @ w - b) ** 2).mean())
        assert r.rows == own.sum() and np.allclose(r.weights, w, rtol=1e-5) and np.isclose(r.mse, mse, rtol=1e-5)
        assert np.isclose(r.intercept, b, rtol=1e-5, atol=1e-4 * max(1, far / 1e3))
        errors.setdefault(r.alpha, []).append(mse)
    assert best.alpha == min(alphas, key=lambda a: np.mean(errors[a]))
    w, b = refit(pdf[NAMES].to_numpy(), pdf.target.to_numpy(), best.alpha)
    assert np.allclose(best.weights, w, rtol=1e-5)


def test_same_fit_and_predictions_as_the_estimator(spark):
    df = frame(spark)
    best, _ = ridge_grid(df, NAMES, (5.0,), 2)
    fitted = models.fit(models.ridge(models.Shape.of(df, NAMES), 5.0), df, NAMES)
    assert np.allclose(best.weights, fitted.model.coefficients.toArray(), rtol=1e-6) and np.isclose(best.intercept, fitted.model.intercept)
    ours = {r.line_id: r.prediction for r in best.predict(df).collect()}
    assert all(np.isclose(ours[r.line_id], r.prediction) for r in fitted.predict(df).collect())


def test_missing_rows_constant_columns_and_empty_tables(spark):
    df = frame(spark, 60)
    holes = df.withColumn("number_0", F.when(F.col("line_id") % 3 != 0, F.col("number_0"))).withColumn("number_1", F.lit(4.0))
    holes = holes.withColumn("target", F.when(F.col("line_id") % 4 != 0, F.col("target")).otherwise(float("nan")))
    best, table = ridge_grid(holes, NAMES, (1.0,), 3)
    whole = holes.where("number_0 is not null and not isnan(target)")
    assert sum(r.rows for r in table.collect()) == whole.count()
    again, _ = ridge_grid(whole, NAMES, (1.0,), 3)
    assert np.allclose(best.weights, again.weights) and abs(best.weights[1]) < 1e-12
    none, table = ridge_grid(df.limit(0), NAMES, (1.0, 2.0), 2)
    assert list(none.weights) == [0, 0, 0] and none.alpha == 2.0 and all(r.mse is None and r.rows == 0 for r in table.collect())
    mean, _ = ridge_grid(df, [], (1.0,), 2)
    assert np.isclose(mean.intercept, df.agg(F.avg("target")).first()[0])
    assert best.predict(holes).where("prediction is null").count() == holes.where("number_0 is null").count()


def test_one_pass_whatever_the_grid(spark, monkeypatch):
    df, calls = frame(spark, 50), []
    map_in_arrow = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a: (calls.append(f.__name__), map_in_arrow(self, f, *a))[1])
    ridge_grid(df, NAMES, tuple(10.0**k for k in range(-5, 5)), 5)
    assert calls.count("products") == 1


def test_too_many_features(spark):
    with pytest.raises(ValueError):
        fold_sums(frame(spark, 3), [f"n{i}" for i in range(5000)], 2)
    assert Linear(["a b"], [2.0], 1.0, 0.0).predict(spark.createDataFrame([(1, 3.0)], "line_id long, `a b` double")).first().prediction == 7.0
