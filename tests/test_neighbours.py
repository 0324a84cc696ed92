import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from colweave.operators import neighbours
from colweave.operators.neighbours import neighbour_distances, neighbour_information, rank_pairs


def psi(n):
    return -0.57721566490153286 + sum(1 / j for j in range(1, n))


def by_hand(pairs, k):
    """Every point against every other one."""
    x, y = np.array(pairs).T
    total = 0.0
    for a, b in zip(x, y, strict=True):
        dx, dy = np.abs(x - a), np.abs(y - b)
        d = np.sort(np.maximum(dx, dy))[k]
        total += psi(int((dx < d).sum())) + psi(int((dy < d).sum()))
    return max(0.0, psi(k) + psi(len(x)) - total / len(x))


def frame(spark, n=1000, seed=5):
    """A dependent column, one of seven values, one without any relation and with holes; a far value."""
    rng = np.random.default_rng(seed)
    t = rng.standard_normal(n)
    a, b, c = t + 0.3 * rng.standard_normal(n), np.floor(t * 2).clip(-3, 3), rng.standard_normal(n)
    a[0] = 1e9
    rows = [(i * 3, float(a[i]), float(b[i]), None if i % 5 == 0 else float(c[i]), float(t[i])) for i in range(n)]
    return spark.createDataFrame(rows, "line_id long, number_a double, number_b double, number_c double, target double")


def test_equals_every_point_against_every_other(spark):
    df, names = frame(spark), ["number_a", "number_b", "number_c"]
    points = rank_pairs(df, names, "target", "line_id").collect()
    found = {r["column"]: r.mi for r in neighbour_information(df, names).collect()}
    for i, n in enumerate(names):
        own = [(r.x, r.y) for r in points if r.c == i]
        assert sorted(x for x, _ in own) == sorted(y for _, y in own) == list(range(800 if n == "number_c" else 1000))
        assert found[n] == pytest.approx(by_hand(own, 3), abs=1e-7)
    # the closed form of the two normal columns
    assert found["number_a"] == pytest.approx(0.5 * np.log(1 + 1 / 0.09), abs=0.12) and found["number_c"] < 0.1 < found["number_b"]


def test_few_rows_missing_values_and_plan(spark):
    df = frame(spark, 40)
    few = neighbour_information(df.limit(3), ["number_a"]).collect()
    assert [tuple(r) for r in few] == [("number_a", None)]
    assert neighbour_information(df.limit(0), ["number_a"]).first().mi is None and neighbour_information(df, []).count() == 0
    holes = df.withColumn("number_b", F.lit(float("nan"))).withColumn("number_c", F.col("target"))
    found = {r["column"]: r.mi for r in neighbour_information(holes, ["number_b", "number_c"]).collect()}
    assert found["number_b"] is None and found["number_c"] > 1
    plan = plan_of(neighbour_distances(rank_pairs(df, ["number_a"], "target", "line_id"), 3))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("strip", [5, 32, None])
def test_one_search_and_one_over_borders_whatever_the_density(spark, monkeypatch, strip):
    rng = np.random.default_rng(3)
    n = 400
    shapes = [np.arange(n), rng.permutation(n), np.arange(n)[::-1] ^ 7, np.argsort(np.arange(n) % 7 * 1000 + rng.permutation(n))]
    rows = [(c, int(x), int(y)) for c, ys in enumerate(shapes) for x, y in enumerate(ys)]
    assert all(len(set(ys)) == n for ys in shapes)
    written = []
    kept = neighbours.settle
    monkeypatch.setattr(neighbours, "settle", lambda df, name: written.append(name) or kept(df, name))
    more = [strip] if strip else []
    found = neighbour_distances(spark.createDataFrame(rows, "c int, x long, y long"), 3, *more).collect()
    assert len(written) == 1 and len(found) == 4 * n
    for r in found:
        ys = shapes[r.c]
        apart = np.maximum(np.abs(np.arange(n) - r.x), np.abs(ys - r.y))
        assert r.d == np.sort(apart)[3]
