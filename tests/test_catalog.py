"""Every registered query with a SQL twin is compared with it, value by value."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Boosting with all its rounds takes minutes; tools/check.py compares these, and test_models.py tests the fits.
LONG = {
    "automl_leaderboard", "boost_curve", "candidate_leaderboard", "depth_search", "feature_response", "fit_forest", "fit_gbt_cls",
    "fit_gbt_reg", "fit_linear_svm", "grid_search", "stacked_out_of_fold", "train_freq",
}


@pytest.fixture(scope="module")
def duck(folder):
    con = check.connect(folder)
    yield con
    con.close()


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(SQL) - LONG))
def test_twin(spark, duck, folder, name):
    verdict, detail = check.compare(duck, spark, folder, name, QUERIES[name], SQL[name])
    assert verdict == "ok", detail


def test_entry(spark, folder):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == entry.entry(spark).columns
