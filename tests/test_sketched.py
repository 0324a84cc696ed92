import numpy as np
import pytest

from colweave import tables
from colweave.operators import select
from colweave.operators.sketched import Sketch, candidate_pairs, correlated_columns_sketched


def frame(spark, x):
    names = [f"n{i}" for i in range(x.shape[1])]
    rows = [(k, *[None if np.isnan(v) else float(v) for v in row]) for k, row in enumerate(x)]
    return spark.createDataFrame(rows, "line_id long, " + ", ".join(f"{n} double" for n in names)), names


def late(x, limit):
    with np.errstate(invalid="ignore", divide="ignore"):
        r = np.nan_to_num(np.abs(np.corrcoef(x.T)))
    return [f"n{i}" for i in np.flatnonzero(np.triu(r > limit, 1).any(0))]


def related(rows, width, seed):
    """Columns of which many follow an earlier one with noise of all sizes, some negated, some far from zero, some still."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rows, width))
    for i in range(20, width, 2):
        x[:, i] = rng.choice([-3, 0.01, 1]) * x[:, rng.integers(0, i)] + rng.uniform(0, 0.6) * rng.standard_normal(rows) * 0.5
    x[:, 5] = 7.0
    x[:, 9] += 1e6
    return x


@pytest.mark.parametrize("limit", [0.95, 0.8, 0.4])
def test_same_columns_as_the_matrix(spark, limit):
    x = related(400, 120, 1)
    df, names = frame(spark, x)
    assert correlated_columns_sketched(df, names, limit) == late(x, limit)


def test_missing_values_copies_and_empty_tables(spark):
    x = related(300, 40, 2)
    x[:, 30] = -x[:, 3]
    x[::3, 31] = np.nan
    x[:, 32] = np.where(np.arange(300) % 4 == 0, np.nan, x[:, 3])
    x[:, 33] = np.nan
    x[:, 34:38] = x[:, [3]]
    df, names = frame(spark, x)
    assert correlated_columns_sketched(df, names) == select.correlated_columns(df, names)
    assert correlated_columns_sketched(df.limit(0), names) == [] == correlated_columns_sketched(df, names[:1])
    assert correlated_columns_sketched(df.drop("line_id"), names) == select.correlated_columns(df, names)


def test_three_thousand_columns(spark, folder):
    df = tables.very_wide_orders(spark, folder, 3000)
    names = [c for c in df.columns if c != "line_id"]
    x = df.select(*names).toArrow().to_pandas().to_numpy()
    with np.errstate(invalid="ignore", divide="ignore"):
        r = np.nan_to_num(np.abs(np.corrcoef(x.T)))
    got = set(correlated_columns_sketched(df, names))
    # Correlations at the limit itself hang on rounding.
    want = {names[i] for i in np.flatnonzero(np.triu(r > 0.95 + 1e-9, 1).any(0))}
    assert want <= got <= {names[i] for i in np.flatnonzero(np.triu(r > 0.95 - 1e-9, 1).any(0))} and len(got) > 500


def test_recall_of_candidates_just_above_the_limit():
    rng, found, n = np.random.default_rng(4), 0, 1500
    p = Sketch()
    a = rng.standard_normal((n, p.directions))
    b = 0.955 * a + np.sqrt(1 - 0.955**2) * rng.standard_normal((n, p.directions))  # sketches of pairs with r = 0.955
    pairs = {(i, j) for i, j, _ in candidate_pairs(np.concatenate([a, b]), 0.95, p)}
    found = sum((i, n + i) in pairs for i in range(n))
    assert found >= 0.999 * n and len(pairs) < 1.1 * n


def test_copies_do_not_give_all_pairs():
    rng = np.random.default_rng(5)
    one = rng.standard_normal((1, 504))
    pairs = candidate_pairs(np.repeat(one, 700, 0), 0.95, Sketch())
    assert len(pairs) == 699 and {j for _, j, _ in pairs} == set(range(1, 700))
