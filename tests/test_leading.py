import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from colweave import tables
from colweave.operators import project, select
from colweave.operators.leading import leading_components


def frame(spark, width=60, rows=400, seed=3):
    """Three strong directions over a floor of noise; far from zero."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((rows, 3)) * [30, 12, 5] @ rng.standard_normal((3, width))
    x = base + rng.standard_normal((rows, width)) + 1000
    names = [f"number_{i}" for i in range(width)]
    kind = "line_id long, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], kind), names, x


def exact(x):
    values, vectors = np.linalg.eigh(np.cov(x.T))
    return values[::-1] / values.sum(), vectors[:, ::-1]


def test_shares_and_directions_equal_the_full_matrix(spark):
    df, names, x = frame(spark)
    shares, vectors = exact(x)
    found = leading_components(df, names, 3, block=4)
    assert found.reached and np.allclose(found.ratios, shares[:3], atol=1e-6)
    assert np.allclose(np.abs((found.vectors * vectors[:, :3]).sum(0)), 1, atol=1e-5)
    rows = np.array(found.apply(df).orderBy("line_id").collect())
    assert np.allclose(np.abs(rows[:, 1:]), np.abs((x - x.mean(0)) @ vectors[:, :3]), atol=1e-2)


def test_number_of_components_by_share(spark):
    df, names, x = frame(spark, 20)
    cumulative = np.cumsum(exact(x)[0])
    for limit in (0.5, 0.95, 0.9999):
        found = leading_components(df, names, limit=limit, block=2)
        assert found.reached and len(found.ratios) == int(np.searchsorted(cumulative, limit, "right")) + 1


def test_same_shares_as_the_full_fit_on_vectors(spark, folder):
    df = tables.embedding_features(spark, folder)
    names = project.by_prefix(df.columns)
    full = select.principal_components(df, names).ratios
    found = leading_components(df, names, 8)
    assert np.allclose(found.ratios, full[:8], atol=1e-6) and found.error < 1e-6


def test_few_numbers_leave_the_tasks(spark):
    """500 columns, where the full matrix has 250,000 numbers: passes of 500 x 4."""
    df = spark.range(300).select(
        F.col("id").alias("line_id"), *[(F.sin(F.col("id") * (1 + i % 5)) * (1 + i % 7) + F.lit(i)).alias(f"number_{i}") for i in range(500)]
    )
    found = leading_components(df, [f"number_{i}" for i in range(500)], 3, block=4)
    assert found.reached and found.passes <= 4 and sum(found.ratios) < 1
    assert "SortMergeJoin" not in plan_of(found.apply(df))


def test_missing_constant_and_empty(spark):
    df, names, x = frame(spark, 5, 50)
    holes = df.withColumn("number_1", F.when(F.col("line_id") % 4 != 0, F.col("number_1")).otherwise(float("nan")))
    holes = holes.withColumn("number_1", F.when(~F.isnan("number_1"), F.col("number_1")))
    y = x.copy()
    y[::4, 1] = np.mean(np.delete(x[:, 1], np.s_[::4]))
    assert np.allclose(leading_components(holes, names, 5).ratios, exact(y)[0], atol=1e-6)
    assert leading_components(df.limit(0), names, 2).ratios == () and leading_components(df, [], 2).ratios == ()
    assert leading_components(df.withColumn("number_0", F.lit(3.0)), ["number_0"], 1).ratios == ()
    assert leading_components(df, names, 99).ratios == pytest.approx(exact(x)[0], abs=1e-6)
