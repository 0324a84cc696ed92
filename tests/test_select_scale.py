import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colweave.operators import scale, select


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, a, None if i % 7 == 0 else b, 2 * a + 1, None if i % 5 == 0 else a + 0.1 * b, 3.0, 3 * a + b))
    return spark.createDataFrame(
        rows, "line_id bigint, `number_a.x` double, number_b double, number_c double, number_d double, number_k double, target double"
    )


NAMES = ["number_a.x", "number_b", "number_c", "number_d", "number_k"]


def _columns(df, names):
    data = df.select(*[F.col(f"`{n}`") for n in names]).collect()
    return np.array([[np.nan if v is None else v for v in r] for r in data])


def test_correlations_pair_by_pair(numbers):
    x = _columns(numbers, NAMES)
    got = {(a, b): r for a, b, r in select.correlation_matrix(numbers, NAMES).collect()}
    for i, a in enumerate(NAMES):
        for j in range(i + 1, len(NAMES)):
            r = got[(a, NAMES[j])]
            if "number_k" in (a, NAMES[j]):
                assert r is None
                continue
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-10)


def test_many_columns_use_several_blocks(spark):
    rnd = random.Random(2)
    rows = [tuple(rnd.random() if rnd.random() > 0.1 else None for _ in range(15)) for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"number_{i} double" for i in range(15)))
    x = _columns(df, df.columns)
    got = {(a, b): r for a, b, r in select.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 15 * 14 // 2
    for (a, b), r in got.items():
        i, j = df.columns.index(a), df.columns.index(b)
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-10)


def test_later_column_of_each_pair_goes(spark):
    df = spark.range(50).selectExpr("id * 1.0D a", "id * 2.0D b", "id * -3.0D c", "pmod(id * 37, 50) * 1.0D d")
    assert select.correlated_columns(df, ["a", "b", "c", "d"]) == ["b", "c"]


def test_top_by_target(numbers):
    x = _columns(numbers, [*NAMES, "target"])
    ranked = select.top_by_target(numbers, NAMES, select.columns_within(5, 100, 50)).collect()
    assert len(ranked) == 2
    by_hand = {}
    for i, n in enumerate(NAMES[:4]):
        both = ~np.isnan(x[:, i])
        by_hand[n] = abs(np.corrcoef(x[both, i], x[both, 5])[0, 1])
    order = sorted(by_hand, key=by_hand.get, reverse=True)
    assert {r["column"] for r in ranked} == set(order[:2])
    assert ranked[0]["abs_corr"] == pytest.approx(by_hand[order[0]])
    assert select.top_by_target(numbers, NAMES, select.columns_within(5, 100, 1000)).count() == 5


def test_variance(spark):
    df = spark.range(100).selectExpr("id * 1.0D a", "id % 2 * 0.06D b", "1.0D c")
    assert select.varying_columns(df, ["a", "b", "c"]) == ["a"]


def test_mutual_information(spark):
    rnd = random.Random(4)
    rows = [(x := rnd.random(), rnd.random(), x * x, None if rnd.random() < 0.5 else x) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, target double, c double").withColumn("k", F.lit(2.0))
    got = {r["column"]: r["mi"] for r in select.mutual_information(df, ["a", "b", "c", "k"]).collect()}

    def brute(pairs):
        def bins(v):
            ordered = sorted(v)
            cuts = {ordered[math.ceil(len(v) * k / 16) - 1] for k in range(1, 16)}
            return [sum(c < e for c in cuts) for e in v]

        bx, by = bins([p[0] for p in pairs]), bins([p[1] for p in pairs])
        joint = np.zeros((16, 16))
        for i, j in zip(bx, by, strict=True):
            joint[i, j] += 1
        p = joint / joint.sum()
        px, py = p.sum(1, keepdims=True), p.sum(0, keepdims=True)
        with np.errstate(all="ignore"):
            return float(np.nansum(np.where(p > 0, p * np.log(p / (px * py)), 0)))

    # Cuts come from a sketch and may lie a few rows off.
    assert got["a"] == pytest.approx(brute([(r[0], r[2]) for r in rows]), abs=0.05)
    assert got["b"] == pytest.approx(brute([(r[1], r[2]) for r in rows]), abs=0.02)
    assert got["k"] == pytest.approx(0.0, abs=1e-12)
    assert got["a"] > 10 * got["b"] and got["c"] > 10 * got["b"]
    table = select.mutual_information(df, ["a", "b", "k"])
    assert {r["column"] for r in select.above_spread(table, "mi", 0.5).collect()} == {"a"}


def test_one_far_value_does_not_change_the_ranking(spark):
    rnd = random.Random(6)
    rows = [(x := rnd.random(), rnd.random(), x) for _ in range(3000)] + [(1e6, 0.5, 1e6)]
    df = spark.createDataFrame(rows, "a double, b double, target double")
    got = {r["column"]: r["mi"] for r in select.mutual_information(df, ["a", "b"]).collect()}
    assert got["a"] > 2.5 and got["b"] < 0.2


def test_components(numbers):
    names = ["number_a.x", "number_c", "target"]
    x = _columns(numbers, names)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    found = select.principal_components(numbers, names)
    assert np.allclose(found.ratios, values / values.sum(), atol=1e-9)
    assert found.count == int(np.argmax(np.cumsum(values / values.sum()) > 0.99)) + 1
    assert sum(found.ratios) == pytest.approx(1.0)


def test_scaler_uses_population_statistics(numbers):
    names = ["number_a.x", "number_b", "number_k"]
    x = _columns(numbers, names)
    fitted = scale.Scaler.fit(numbers, names)
    got = _columns(fitted.apply(numbers).orderBy("line_id"), names)
    assert np.allclose(got[:, 0], (x[:, 0] - x[:, 0].mean()) / x[:, 0].std())
    assert np.allclose(got[:, 1], (x[:, 1] - np.nanmean(x[:, 1])) / np.nanstd(x[:, 1]), equal_nan=True)
    assert (got[:, 2] == 0).all()


def test_scaler_single_precision_and_missing_column(spark):
    df = spark.range(10).selectExpr("id / 3 a", "cast(null as double) b")
    out = scale.Scaler.fit(df, ["a", "b"], single=True).apply(df)
    assert dict(out.dtypes)["a"] == "float" and out.where("b is not null").isEmpty()


def test_each_table_by_itself(spark):
    one, two = spark.range(10).selectExpr("id * 1.0D a"), spark.range(10).selectExpr("id * 100.0D a")
    a, b = scale.scale_each([one, two], ["a"])
    assert np.allclose(sorted(r[0] for r in a.collect()), sorted(r[0] for r in b.collect()))
