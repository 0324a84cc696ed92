from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from colweave import catalog, tables
from colweave.operators import split
from colweave.operators.project import EmptyInput
from colweave.plans import models, pipeline
from colweave.schema import Roles
from conftest import plan_of

RECIPES = {
    "onehot": pipeline.ONEHOT, "fill_first": pipeline.FILL_FIRST, "frequency": pipeline.FREQUENCY,
    "budget": replace(pipeline.BUDGET, most_columns=60),
}


@pytest.fixture(scope="module")
def orders(spark, folder):
    return tables.orders_features(spark, folder)


@pytest.mark.parametrize("name", RECIPES)
def test_replay_is_one_projection(orders, name):
    prepared = pipeline.prepare(orders, RECIPES[name])
    out = prepared.transform(orders)
    assert out.columns == ["line_id", "target", *prepared.used]
    nulls = out.selectExpr(*[f"count_if(`{c}` is null) as `{c}`" for c in out.columns]).first()
    assert not any(nulls)
    again = prepared.transform(orders.repartition(3))
    assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()
    scored = prepared.transform(orders.drop("target"))
    assert scored.columns == ["line_id", *prepared.used]


@pytest.mark.parametrize("name", RECIPES)
def test_scored_table_is_not_shuffled(spark, folder, orders, name, tmp_path):
    path = str(tmp_path / "t")
    orders.write.parquet(path)
    flat = spark.read.parquet(path)
    plan = plan_of(pipeline.prepare(flat, RECIPES[name]).transform(flat))
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan


def test_replay_runs_on_a_stream(spark, folder, orders, tmp_path):
    path = str(tmp_path / "t")
    orders.write.parquet(path)
    prepared = pipeline.prepare(spark.read.parquet(path), pipeline.FREQUENCY)
    stream = prepared.transform(spark.readStream.schema(orders.schema).parquet(path))
    assert stream.isStreaming
    run = stream.writeStream.format("memory").queryName("replayed").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.table("replayed").count() == orders.count()


def test_scaled_columns(orders):
    prepared = pipeline.prepare(orders, pipeline.ONEHOT)
    out = prepared.transform(orders)
    row = out.agg(F.avg("number_0"), F.stddev_pop("number_0"), F.stddev_pop("`onehot_string_1=F`"), F.max("number_null")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == pytest.approx(1) and row[3] == 0
    assert "number_const" not in prepared.used and not any(c.endswith("=nan") for c in prepared.used)


def test_budget_drops_copies(orders):
    used = pipeline.prepare(orders, RECIPES["budget"]).used
    assert "number_1" in used and "number_2" not in used


def test_unseen_and_missing_at_scoring(spark):
    train = spark.createDataFrame([(i, float(i), "a" if i % 3 else "b", 1.0 * i) for i in range(30)], "line_id bigint, number_0 double, id_0 string, target double")
    new = spark.createDataFrame([(100, None, "zzz"), (101, 5.0, None), (102, 1.0, "b")], "line_id bigint, number_0 double, id_0 string")
    got = pipeline.prepare(train, pipeline.FREQUENCY).transform(new).orderBy("line_id").collect()
    # nothing was missing in training, so numbers take the training mean
    assert [(r["number_0"], r["id_0"]) for r in got] == [(14.5, -1), (5.0, -1), (1.0, 10)]
    by_self = pipeline.prepare(train, pipeline.FREQUENCY, stats="self").transform(new).orderBy("line_id").first()
    assert by_self["number_0"] == 3.0
    hollow = train.withColumn("number_0", F.when(F.col("line_id") > 0, F.col("number_0")))
    assert pipeline.prepare(hollow, pipeline.FREQUENCY).transform(new).orderBy("line_id").first()["number_0"] == -1.0


def test_roles(spark):
    df = spark.createDataFrame([(i, i % 3 * 1.0, i * 1.0, i * 2.0) for i in range(12)], "line_id bigint, number_0 double, number_1 double, price double")
    prepared = pipeline.prepare(df, pipeline.FREQUENCY, Roles({"number_0": "categorical", "price": "output", "number_1": "number"}))
    out = prepared.transform(df)
    assert out.columns == ["line_id", "target", "number_0", "number_1"]
    assert {r["number_0"] for r in out.collect()} == {4}


def test_guards(spark):
    one = spark.createDataFrame([(1, 2.0, 3.0)], "line_id bigint, number_0 double, target double")
    with pytest.raises(EmptyInput, match="at least 2"):
        pipeline.prepare(one)
    constant = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 4.0)], "line_id bigint, number_0 double, target double")
    with pytest.raises(EmptyInput, match="no feature"):
        pipeline.prepare(constant)


@pytest.mark.parametrize("name", ["onehot", "frequency"])
def test_save_and_load(spark, orders, name, tmp_path):
    train, test = split.split_hash(orders)
    scorer = pipeline.train(train, models.REGRESSION, models.ridge, RECIPES[name])
    pipeline.save(scorer, str(tmp_path / "m"))
    loaded = pipeline.load(spark, str(tmp_path / "m"))
    assert loaded.prepared.used == list(scorer.prepared.used) and loaded.mode == scorer.mode
    a = {r["line_id"]: r["prediction"] for r in scorer.predict(test).collect()}
    b = {r["line_id"]: r["prediction"] for r in loaded.predict(test).collect()}
    assert a == pytest.approx(b)


def test_train_best_and_batch(spark, folder, orders, tmp_path):
    train, test = split.split_hash(orders)
    scorer, board = pipeline.train_best(train, models.REGRESSION, {"forest": models.forest(models.REGRESSION, 3)}, depths=[2, 3])
    assert board.count() == 1 and scorer.predict(test).count() == test.count()
    forest = {"forest": models.forest(models.REGRESSION, 3)}
    hurried, _ = pipeline.train_best(train, models.REGRESSION, forest, depths=[2, 3], seconds=0.0)
    assert hurried.fitted.model.getMaxDepth() == 2
    sets = {
        "orders": (models.REGRESSION, train, test),
        "events": (models.CLASSIFICATION, *split.split_hash(tables.events_features(spark, folder))),
    }
    out = str(tmp_path / "predictions")
    rows = {r["dataset"]: r for r in pipeline.run_all(spark, sets, models.linear, pipeline.FREQUENCY, out).collect()}
    back = spark.read.schema("line_id bigint, prediction double").option("header", True).csv(f"{out}/orders")
    assert rows["orders"]["predicted_rows"] == back.where("prediction is not null").count() == test.count()
    joined = back.join(test.select("line_id", "target"), "line_id")
    assert joined.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("target"), 2)))).first()[0] == pytest.approx(rows["orders"]["score"])
    metrics = pipeline.run_metrics(spark, scorer, dataset="orders").first()
    assert metrics["method"] == "RandomForestRegressionModel" and '"maxDepth": ' in metrics["parameters"]
    assert metrics["mode"] == models.REGRESSION and metrics["train_bytes"] > 0 and metrics["dataset"] == "orders"
    assert rows["orders"]["rows"] == train.count() and len({r["run_id"] for r in rows.values()}) == 1
    assert rows["orders"]["score"] < test.agg(F.stddev_pop("target")).first()[0]
    assert 0 <= rows["events"]["score"] <= 1


def test_compact(spark):
    rows = [(i, "abcde"[i % 5], f"w{i % 30}", f"u{i}", i % 100, 7, i / 2) for i in range(300)]
    df = spark.createDataFrame(rows, "line_id bigint, string_a string, string_b string, id_0 string, number_i bigint, number_k bigint, target double")
    out = pipeline.compact(df)
    kinds = dict(out.dtypes)
    assert kinds["onehot_string_a=c"] == "tinyint" and "string_a" not in kinds and "number_k" not in kinds
    assert kinds["number_i"] == "tinyint" and kinds["string_b"] == "bigint" and kinds["id_0"] == "string"


def test_spread_keeps_pruning_and_pushdown(spark, folder):
    df = tables.read(spark, folder, "orders").where("o_totalprice > 1000").select("o_custkey")
    plan = plan_of(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_totalprice,1000.0)" in plan


def test_a_loaded_scorer_can_be_saved_to_its_own_folder(spark, tmp_path, orders):
    path = str(tmp_path / "m")
    made = pipeline.train(orders, models.REGRESSION, models.ridge, pipeline.FREQUENCY)
    pipeline.save(made, path)
    pipeline.save(pipeline.load(spark, path), path)
    assert pipeline.load(spark, path).predict(orders).count() == orders.count()


def test_nan_infinity_and_decimals(spark, tmp_path, orders):
    odd = orders.withColumns({
        "number_0": F.when(F.col("line_id") % 5 == 0, F.lit(float("nan"))).when(F.col("line_id") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("number_0")),
        "number_1": F.col("number_1").cast("decimal(10,2)"),
    })
    plain = odd.withColumns({
        "number_0": F.when((F.col("line_id") % 5 != 0) & (F.col("line_id") % 7 != 0), F.col("number_0")),
        "number_1": F.col("number_1").cast("double"),
    })
    a, b = (pipeline.prepare(df, pipeline.ONEHOT).transform(df).orderBy("line_id").collect() for df in (odd, plain))
    assert a == b
    made = pipeline.train(odd, models.REGRESSION, models.ridge, pipeline.ONEHOT)
    pipeline.save(made, str(tmp_path / "d"))
    assert pipeline.load(spark, str(tmp_path / "d")).predict(odd).where("prediction is null").count() == 0


def test_a_fit_reads_its_source_once(spark, orders):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    source = orders.mapInArrow(counted, orders.schema)
    pipeline.train(source, models.REGRESSION, models.ridge, pipeline.FREQUENCY)
    assert rows.value == orders.count()


@pytest.mark.parametrize("name", ["prep_onehot_nan", "prep_onehot", "prep_freq"])
def test_preparations_do_not_join_their_source_again_in_every_pass(spark, folder, name):
    written = catalog.queries()[name](spark, folder)
    files = {f.rpartition("/")[0] for f in written.inputFiles()}
    assert not any(f.startswith(folder) for f in files), files
