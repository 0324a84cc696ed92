import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from colweave import tables
from colweave.catalog import registry
from colweave.operators import score, split
from colweave.plans import models, pipeline, response, search
from colweave.schema import LABEL


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        a, b = rnd.gauss(0, 1), rnd.gauss(1, 2)
        rows.append((i, a, b, 4 * a - 2 * b + 3 + rnd.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "line_id bigint, `number_a.x` double, number_b double, target double").cache()


@pytest.fixture(scope="module")
def classes(table):
    return table.withColumn(LABEL, (F.col(LABEL) > 1).cast("double")).cache()


NAMES = ["number_a.x", "number_b"]


def _matrix(df):
    data = np.array([[r["number_a.x"], r["number_b"], r["target"]] for r in df.collect()])
    return data[:, :2], data[:, 2]


def test_ridge_closed_form(table):
    x, y = _matrix(table)
    centred = x - x.mean(0)
    for alpha in (1.0, 50.0):
        w = np.linalg.solve(centred.T @ centred + alpha * np.eye(2), centred.T @ (y - y.mean()))
        fitted = models.fit(models.ridge(models.Shape.of(table, NAMES), alpha), table, NAMES)
        assert np.allclose(fitted.model.coefficients.toArray(), w, atol=1e-8)
        assert fitted.model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-8)


def test_logistic_against_newton(classes):
    x, y = _matrix(classes)
    full = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ w))
        gradient = full.T @ (p - y) + penalty @ w
        w -= np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + penalty, gradient)
    fitted = models.fit(models.logistic(models.Shape.of(classes, NAMES)), classes, NAMES)
    assert np.allclose(fitted.model.coefficients.toArray(), w[:2], atol=1e-3)
    proba = fitted.predict(classes, probability=True)
    assert proba.where("prediction < 0 or prediction > 1").isEmpty()
    assert score.auc(proba).first()[0] > 0.95


@pytest.mark.parametrize("kind", ["boost", "slow", "forest"])
def test_trees_beat_the_mean(table, kind):
    train, test = split.split_hash(table)
    made = {
        "boost": lambda: models.boosted(models.REGRESSION, 10),
        "slow": lambda: models.boosted(models.REGRESSION, 10, slow=True),
        "forest": lambda: models.forest(models.REGRESSION, 5),
    }[kind]()
    scored = models.fit(made, train, NAMES).predict(test)
    assert scored.columns == ["line_id", "target", "prediction"]
    spread = test.agg(F.stddev_pop("target")).first()[0]
    assert score.rmse(scored).first()[0] < spread


def test_classifiers_beat_a_coin(classes):
    train, test = split.split_hash(classes)
    shape = models.Shape.of(train, NAMES)
    for made in (models.boosted(models.CLASSIFICATION, 3), models.forest(models.CLASSIFICATION, 5), models.linear_svm(shape)):
        assert score.auc_of_labels(models.fit(made, train, NAMES).predict(test)).first()[0] > 0.8


def test_leaderboard_on_all_rows_and_on_a_split(table):
    made = {"ridge": models.ridge(models.Shape.of(table, NAMES)), "forest": models.forest(models.REGRESSION, 2, maxDepth=2)}
    board = search.leaderboard(made, table, NAMES, models.REGRESSION)
    assert search.winner(board).first()["model"] == "ridge"
    assert board.where("fit_rows_s <= 0 or predict_rows_s <= 0 or score is null").isEmpty()
    name, last = search.select_model(made, table, NAMES, models.REGRESSION, samples=(200, 400))
    assert name == "ridge" and last.count() >= 1


def test_leaderboard_inside_a_training_part(spark, folder):
    big = spark.range(40_000).selectExpr("id line_id", "(id * 37 % 101) * 1.0D number_0", "(id * 37 % 101) * 2.0D target")
    train, _ = split.split_hash(big)
    board = search.leaderboard({"ridge": models.ridge(models.Shape.of(train, ["number_0"]))}, train, ["number_0"], models.REGRESSION)
    assert board.first()["score"] > -1.0


def test_the_automatic_search_boosts_all_its_rounds(spark, tmp_path, monkeypatch):
    rows = spark.range(80).selectExpr(
        "id event_id", "timestampadd(hour, id, timestamp'2024-01-01 00:00:00') ts", "id % 7 user_id", "if(id % 3 = 0, 'click', 'view') event_type",
        "id % 11 * 1.5D value", """concat('{"k": ', id % 9, '}') props""",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    tried = []
    monkeypatch.setattr(search, "_timed_fit", lambda e, *rest: tried.append(e) or (0.5, 1, 1))
    board = registry.queries()["automl_leaderboard"](spark, str(tmp_path))
    assert [r["model"] for r in board.collect()] == ["linear", "forest", "boost_fast", "boost_slow", "linear_svm"]
    assert [e.getMaxIter() for e in tried if isinstance(e, GBTClassifier)] == [models.BOOST_ROUNDS] * 2 == [100, 100]


def test_survivors(spark):
    board = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0), ("d", 2.0)], "model string, score double")
    assert {r["model"] for r in search.survivors(board).collect()} == {"b", "c", "d"}
    equal = board.withColumn("score", F.lit(0.5))
    assert search.survivors(equal).count() == 4
    assert search.winner(equal).first()["model"] == "a"


@pytest.mark.parametrize(("scores", "kept"), [([1, 2, 2, 1], 4), ([1, 2, 3], 4), ([3, 1, 9], 2), ([5], 2)])
def test_first_best_rule(spark, scores, kept):
    trials = spark.createDataFrame([(i + 2, float(s)) for i, s in enumerate(scores)], "depth int, score double")
    assert search.first_best(trials).first()["depth"] == kept


def test_sample_plan(spark):
    board = spark.createDataFrame([("a", 0.1, 1000, 10_000), ("b", 0.1, 1, 10)], "model string, score double, fit_rows_s bigint, predict_rows_s bigint")
    got = {r["model"]: r["sample_rows"] for r in search.sample_plan(board, 100_000, 600.0, 15).collect()}
    by_hand = int((600 - 3 * 100_000 / 1000) / 15 / (0.75 / 1000 + 0.25 / 10_000))
    assert got == {"a": by_hand, "b": 0}


def test_depth_and_grid_search(table):
    best, tried = search.depth_search(models.boosted(models.REGRESSION, 2), table, NAMES, models.REGRESSION, [2, 3])
    assert tried.count() == 2 and best.getMaxDepth() in (2, 3)
    fitted, rows = search.grid_search(models.boosted(models.REGRESSION, 2), {"maxDepth": [1, 4]}, table, NAMES, models.REGRESSION)
    scores = {r["params"]: r["score"] for r in rows.collect()}
    assert scores["maxDepth=4"] > scores["maxDepth=1"] and fitted.model.getMaxDepth() == 4


def test_responses_of_a_linear_model(table):
    fitted = models.fit(models.ridge(models.Shape.of(table, NAMES)), table, NAMES)
    w = dict(zip(NAMES, fitted.model.coefficients.toArray(), strict=True))
    for r in response.responses(fitted, table, NAMES).collect():
        step = w[r["feature"]] * r["delta"]
        assert r["fr_inc"] == pytest.approx(step) and r["fr_dec"] == pytest.approx(-step)
        assert r["frd_abs"] == pytest.approx(abs(step)) and r["fri_mad"] == pytest.approx(abs(step))


def test_boost_curve_falls(table):
    fitted = models.fit(models.boosted(models.REGRESSION, 8), table, NAMES)
    errors = [r["rmse"] for r in response.boost_curve(fitted, table).orderBy("iter").collect()]
    assert len(errors) == 8 and errors[-1] < errors[0]
    assert errors[-1] == pytest.approx(score.rmse(fitted.predict(table)).first()[0], rel=1e-6)


def test_feature_table_has_every_feature(table):
    fitted = models.fit(models.boosted(models.REGRESSION, 3), table, NAMES)
    got = {r["feature"]: r for r in response.feature_table(fitted, table).collect()}
    assert set(got) == set(NAMES) and sum(r["importance"] for r in got.values()) == pytest.approx(1.0)


def test_document_quality_model_runs(spark, folder):
    df = tables.labelled_documents(spark, folder)
    assert df.count() > 0 and set(df.columns) >= {"line_id", "target", "number_0", "string_0"}


def _rows_per_part(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def test_fit_does_not_pass_over_many_tiny_parts(table):
    parts = _rows_per_part(models.training_vectors(table.repartition(150), NAMES).persist())
    assert parts == [600]


def test_fit_cuts_large_parts_by_size(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_BYTES", 64_000)
    df = spark.range(0, 40_000, 1, 1).selectExpr("if(id % 2 = 0, id, null) as line_id", "id * 1.5D as number_a", "id % 7 as target")
    parts = _rows_per_part(models.training_vectors(df, ["number_a"]))
    assert len(parts) == 15 and sum(parts) == 40_000
    assert max(parts) < 1.2 * 40_000 / 15  # rows without a key too


def test_tasks_grow_with_the_table_and_not_their_share():
    sizes = [models.fit_tasks(rows, 14, 12) for rows in (0, 30_000, 10**6, 10**8, 10**9)]
    assert sizes == [1, 1, 12, 382, 3815]


def test_leaderboard_cuts_large_parts_by_size(spark, table, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "TASK_BYTES", 2_000)
    monkeypatch.setattr(search, "_timed_fit", lambda e, train, *rest: seen.append(train.rdd.getNumPartitions()) or (0.0, 1, 1))
    search.leaderboard({"a": None}, table.coalesce(1), NAMES, models.REGRESSION)
    assert seen == [10]


def test_orders_are_not_held_at_the_number_of_shuffle_parts(spark, folder):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "90")
    try:
        assert tables.orders_features(spark, folder).rdd.getNumPartitions() < 90
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_steps_of_a_search_share_one_dealt_table(spark, folder, monkeypatch):
    dealt, deal = [], models.training_vectors
    monkeypatch.setattr(models, "training_vectors", lambda *a: dealt.append(1) or deal(*a))
    monkeypatch.setattr(search, "training_vectors", models.training_vectors)
    made = {"forest": models.forest(models.REGRESSION, 2, maxDepth=3)}
    scorer, _ = pipeline.train_best(tables.orders_features(spark, folder), models.REGRESSION, made, depths=[2, 3])
    assert len(dealt) == 1
    assert scorer.fitted.model.getMaxDepth() in (2, 3)


def test_a_held_table_goes_on_as_it_is(table):
    boost = models.boosted(models.REGRESSION, 2)
    with models.held(table, NAMES) as rows:
        assert models.is_dealt(rows) and not models.is_dealt(table)
        board = search.leaderboard({"boost": boost}, rows, NAMES, models.REGRESSION).first()["score"]
        _, tried = search.depth_search(boost, rows, NAMES, models.REGRESSION, [3])
        assert tried.first()["score"] == board
        name, last = search.select_model({"boost": boost}, rows, NAMES, models.REGRESSION, samples=(200,))
        assert name == "boost" and last.count() == 1
        assert rows.is_cached  # its owner lets it go
    assert not rows.is_cached
