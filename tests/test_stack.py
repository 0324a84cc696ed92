import numpy as np
import pytest
from pyspark.sql import functions as F

from colweave.operators import score
from colweave.operators.split import split_hash, with_fold
from colweave.plans import models
from colweave.plans.ridge import Linear
from colweave.plans.stack import column, fit_stacked, out_of_fold

NAMES = ["number_0", "number_1"]


def frame(spark, n=600, classes=False):
    rng = np.random.default_rng(3)
    x = rng.uniform(-3, 3, (n, 2))
    y = 2 * x[:, 0] + np.sin(2 * x[:, 1]) * 3 + 0.2 * rng.standard_normal(n)
    y = (y > 0).astype(float) if classes else y
    rows = [(k * 5 + 2, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "line_id long, number_0 double, number_1 double, target double")


def families(df, classes=False):
    mode, shape = (models.CLASSIFICATION if classes else models.REGRESSION), models.Shape.of(df, NAMES)
    return {"linear": models.linear(mode, shape), "boost": models.boosted(mode, 10)}


def test_no_row_is_scored_by_a_fit_that_saw_its_fold(spark):
    df = frame(spark, 200)
    found = out_of_fold({"linear": families(df)["linear"]}, df, NAMES, 3)
    rows = {r.line_id: r for r in found.collect()}
    assert len(rows) == found.count() == 200
    for k in range(3):
        rest = with_fold(df, 3).where(F.col("fold") != k)
        fitted = models.fit(families(df)["linear"], rest, NAMES)
        for r in fitted.predict(with_fold(df, 3).where(F.col("fold") == k)).collect():
            assert rows[r.line_id].fold == k and np.isclose(rows[r.line_id][column("linear")], r.prediction)


@pytest.mark.parametrize("classes", [False, True])
def test_the_stack_is_no_worse_than_its_best_family(spark, classes):
    train, test = split_hash(frame(spark, 900, classes))
    stacked = fit_stacked(families(train, classes), train, NAMES, models.CLASSIFICATION if classes else models.REGRESSION)
    scored = stacked.predict(test)
    assert scored.count() == test.count() and set(stacked.weights()) == {"linear", "boost"}
    if classes:
        own = score.auc(scored).first()[0]
        each = [score.auc(f.predict(test, probability=True)).first()[0] for f in stacked.base.values()]
        assert own >= max(each) - 0.01 and own > 0.9
        assert scored.where("prediction between 0 and 1").count() == test.count()
    else:
        assert isinstance(stacked.second, Linear)
        own, each = score.rmse(scored).first()[0], [score.rmse(f.predict(test)).first()[0] for f in stacked.base.values()]
        assert own <= min(each) * 1.01 and own < 1.3


def test_a_useless_family_gets_no_weight(spark):
    df = frame(spark, 400)
    shape = models.Shape.of(df, NAMES)
    useless = models.boosted(models.REGRESSION, 1, maxDepth=1, stepSize=0.001)
    stacked = fit_stacked({"good": models.boosted(models.REGRESSION, 15), "linear": models.ridge(shape, 1e9), "weak": useless}, df, NAMES, models.REGRESSION)
    w = stacked.weights()
    assert w["good"] > 0.5 and abs(w["linear"]) < 0.5


def test_empty_table_and_unknown_mode(spark):
    df = frame(spark, 50)
    assert out_of_fold(families(df), df.limit(0), NAMES).collect() == []
    with pytest.raises(ValueError):
        fit_stacked(families(df), df, NAMES, "other")
