import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from colweave.functions.scalars import row_hash
from colweave.operators import target
from colweave.operators.split import FOLDS


def frame(spark, n=3000):
    """Half of the rows hold one value, an eighth none, the rest 40 values; every ninth label is missing."""
    part = F.col("id") % 8
    value = F.when(part < 4, F.lit("hot")).when(part > 4, F.concat(F.lit("v"), (F.col("id") % 40).cast("string")))
    label = F.when(F.col("id") % 9 != 0, ((F.col("id") * 37) % 101).cast("double") - 30)
    return spark.range(n).select(F.col("id").alias("line_id"), value.alias("string_0"), (F.col("id") % 3).alias("id_0"), label.alias("target"))


def by_hand(df, name, prior_rows):
    rows = df.withColumn("turn", row_hash(F.col("line_id"), FOLDS)).collect()
    labels = [r.target for r in rows if r.target is not None]
    prior, sums, out = sum(labels) / len(labels), {}, {}
    for r in sorted(rows, key=lambda r: (r.turn, r.line_id)):
        n, total = sums.get(r[name], (0, 0.0))
        out[r.line_id] = (total + prior_rows * prior) / (n + prior_rows)
        if r.target is not None:
            sums[r[name]] = (n + 1, total + r.target)
    return prior, sums, out


@pytest.mark.parametrize("parts", [1, 7])
def test_running_means_equal_a_loop_over_the_rows(spark, parts):
    df = frame(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = target.ordered_target_encode(df, ["string_0", "id_0"], prior_rows=2.0).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 3000
    for name in ("string_0", "id_0"):
        _, _, expected = by_hand(df, name, 2.0)
        assert all(r[name] == pytest.approx(expected[r.line_id], abs=1e-9) for r in found)


def test_a_hot_value_is_cut_over_the_parts(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sums = target._sorted_sums(frame(spark, 40_000), ["string_0"], "target", "line_id")
        rows = [r["n"] for r in sums.where("edges is null").groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == 4 and sum(rows) == 40_000 and max(rows) <= 2 * 10_000
    plan = plan_of(sums)
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_scoring_uses_all_rows_of_a_value(spark):
    df = frame(spark)
    means = target.fit_target_means(df, ["string_0"], prior_rows=2.0)
    prior, sums, _ = by_hand(df, "string_0", 2.0)
    asked = spark.createDataFrame([(1, "hot"), (2, None), (3, "new"), (4, "v7")], "line_id long, string_0 string")
    expected = {k: (sums.get(v, (0, 0.0))[1] + 2 * prior) / (sums.get(v, (0, 0.0))[0] + 2) for k, v in [(1, "hot"), (2, None), (3, "new"), (4, "v7")]}
    for limits in ({}, {"most_rows": 0}):
        found = {r.line_id: r.string_0 for r in means.apply(asked, **limits).collect()}
        assert found == {k: pytest.approx(v, abs=1e-9) for k, v in expected.items()}


def test_no_rows_no_labels_no_names(spark):
    df = frame(spark, 20)
    assert target.ordered_target_encode(df.limit(0), ["string_0"]).count() == 0
    bare = target.ordered_target_encode(df.withColumn("target", F.lit(None).cast("double")), ["string_0"])
    assert [r.string_0 for r in bare.collect()] == [None] * 20
    assert target.ordered_target_encode(df, []).collect() == df.collect()
    nan = df.withColumn("target", F.lit(float("nan")))
    assert {r.string_0 for r in target.fit_target_means(nan, ["string_0"]).apply(df).collect()} == {0.0}
