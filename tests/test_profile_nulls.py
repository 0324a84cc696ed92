import pytest
from pyspark.sql import functions as F

from colweave.operators import narrow, nulls, profile, project
from colweave.schema import quoted


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 1.0, None, "a", 5.0), (2, None, None, "b", 5.0), (3, 1.0, None, "a", 6.0), (4, 1.0, None, None, 6.0)]
    return spark.createDataFrame(
        rows, "line_id bigint, number_c double, number_n double, string_0 string, target double"
    )


def test_constant_rules(table):
    # one value plus missing is constant, all missing is not
    assert profile.constant_columns(table) == ["number_c"]
    kept, dropped = profile.drop_constant(table)
    assert dropped == ["number_c"] and "number_n" in kept.columns


def test_profile_counts_missing_as_value(table):
    p = profile.profile(table)
    assert (p["string_0"].distinct, p["string_0"].values) == (2, 3)
    assert (p["number_n"].distinct, p["number_n"].values) == (0, 1)
    assert p["target"].mean == 5.5


def test_empty_text_and_signed_zero_count_once(spark):
    df = spark.createDataFrame([("", 0.0), ("", -0.0), ("a", 0.0)], "s string, d double")
    p = profile.profile(df)
    assert (p["s"].distinct, p["d"].distinct) == (2, 1)


def test_distinct_counts_across_the_sketch_bound(spark):
    df = spark.range(20_000).selectExpr(
        "id a", "id % 3500 b", "cast(id % 5000 as string) c", "id * 0.5D d", "id % 2 = 0 e", "cast(null as int) g",
        "timestamp_seconds(id div 2) h",
    )
    got = {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df).collect()}
    assert got == {"a": 20_000, "b": 3500, "c": 5000, "d": 20_000, "e": 2, "g": 0, "h": 10_000}


def test_wide_profile_runs_in_batches(spark):
    df = spark.range(50).selectExpr(*[f"id % {i + 1} as `number_{i}`" for i in range(450)])
    p = profile.profile(df)
    assert len(p) == 450 and p["number_6"].distinct == 7 and p["number_449"].distinct == 50


def test_any_missing(table, spark):
    assert profile.any_missing(table).first()[0] is True
    assert profile.any_missing(table, ["line_id", "target"]).first()[0] is False
    assert profile.any_missing(table.limit(0)).first()[0] is False


def test_value_counts_order(table):
    assert [tuple(r) for r in profile.value_counts(table, "string_0").collect()] == [("a", 2), ("b", 1)]


def test_prefix_growth(spark):
    df = spark.range(100).selectExpr("id * 3 line_id", "if(id < 50, 1, 2) number_a", "1 number_b", "cast(null as int) number_c")
    got = profile.nonconstant_by_prefix(df, [10, 50, 51, 100], ["number_a", "number_b", "number_c"]).collect()
    assert [tuple(r) for r in got] == [(10, 1), (50, 1), (51, 2), (100, 2)]


def test_steps_of_many_columns_with_gaps(spark):
    def cells(k):
        text = None if k < 4 else "a" if k < 30 else "b"
        return (k * 3, 1.0 if k < 20 else 2.0, text, None, k == 7, float("nan") if k % 2 else None, *([5 if k < 45 else 6] * 25))

    wide = ", ".join(f"number_w{i} int" for i in range(25))
    df = spark.createDataFrame(
        [cells(k) for k in range(1, 51)] + [(None, 9.0, "z", 9.0, True, 9.0, *([9] * 25))],
        f"line_id long, number_a double, string_a string, number_n double, flag boolean, number_nan double, {wide}",
    )
    names = [c for c in df.columns if c != "line_id"]
    got = dict(tuple(r) for r in profile.nonconstant_by_prefix(df, [0, 1, 3, 4, 6, 7, 19, 20, 30, 44, 45, 50], names).collect())
    # number_n has no value at all, string_a none before row 4; flag turns at 7 and back, number_a at 20, string_a at 30
    assert got == {0: 30, 1: 2, 3: 2, 4: 1, 6: 1, 7: 2, 19: 2, 20: 3, 30: 4, 44: 4, 45: 29, 50: 29}
    assert profile.nonconstant_by_prefix(df.limit(0), [5], names).first().n_nonconstant == 30


def test_fills(table):
    first = nulls.fill_constant(table).orderBy("line_id").collect()
    assert [r["number_c"] for r in first] == [1.0, -1.0, 1.0, 1.0]
    assert [r["string_0"] for r in first] == ["a", "b", "a", "-1"]
    mean = nulls.fill_values(table, nulls.means(table, ["number_c", "number_n"])).orderBy("line_id").collect()
    assert mean[1]["number_c"] == 1.0 and mean[0]["number_n"] is None
    assert nulls.maxima(table)["target"] == 6.0


def test_mode_prefers_the_smallest_of_equals(table):
    assert nulls.modes(table, ["target", "string_0", "number_n"]) == {"target": 5.0, "string_0": "a", "number_n": None}


def test_fill_policy(table, spark):
    assert nulls.FillPolicy.fit(table).missing
    full = spark.createDataFrame([(1, 2.0), (2, 4.0)], "line_id bigint, number_0 double")
    hollow = spark.createDataFrame([(3, None), (4, 10.0)], "line_id bigint, number_0 double")
    by_train = nulls.FillPolicy.fit(full).apply(hollow).orderBy("line_id").collect()
    by_self = nulls.FillPolicy.fit(full, stats="self").apply(hollow).orderBy("line_id").collect()
    assert (by_train[0]["number_0"], by_self[0]["number_0"]) == (3.0, 10.0)
    with pytest.raises(ValueError):
        nulls.FillPolicy.fit(full, stats="other")


def test_projection_helpers(table):
    assert project.by_prefix(["number_0", "onehot_a=1", "string_0"]) == ["number_0", "onehot_a=1"]
    names = ["line_id", "target", "number_0", "datetime_0", "string_0", "id_0", "other"]
    assert project.by_denial(names, ["id_0"]) == ["number_0", "id_0", "other"]
    with pytest.raises(Exception, match="no_such"):
        project.pick(table, ["no_such"])
    with pytest.raises(project.EmptyInput):
        project.guard_rows(table.limit(1))
    assert project.guard_rows(table) == 2
    with pytest.raises(project.EmptyInput):
        project.guard_features([])


def test_odd_names_survive(spark):
    df = spark.range(3).selectExpr("id `onehot_x=0.5`", "id `a.b`", "id * 2 `c``d`")
    assert project.pick(df, ["a.b", "onehot_x=0.5", "c`d"]).count() == 3
    assert profile.profile(df)["c`d"].high == 4
    assert quoted("c`d") == "`c``d`"


def test_type_counts(table):
    got = {r["dtype"]: (r["n_columns"], r["n_values"]) for r in project.type_counts(table).collect()}
    assert got == {"bigint": (1, 4), "double": (3, 7), "string": (1, 3)}


@pytest.mark.parametrize(
    ("low", "high", "want"),
    [(0, 127, "tinyint"), (0, 128, "smallint"), (-129, 0, "smallint"), (0, 2**15, "int"), (0, 2**31, "bigint")],
)
def test_smallest_integer(low, high, want):
    assert narrow.smallest_integer(low, high) == want


def test_narrowing(spark):
    df = spark.createDataFrame([(1, -5, 0.1, 1e9 + 0.25), (300, 7, 0.2, 2.0)], "a bigint, b int, c double, d double")
    assert narrow.fit_integers(df).types == {"a": "smallint", "b": "tinyint"}
    assert narrow.fit_integers(df, unsigned=True).types == {"a": "smallint"}
    floats = narrow.fit_floats(df)
    assert floats.types == {"c": "float"}
    assert dict(floats.apply(df).dtypes)["d"] == "double"


def test_sizes(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "cde")], "a bigint, s string")
    assert tuple(narrow.table_bytes(df).first()) == (2, 21)
    small = df.withColumn("a", F.col("a").cast("tinyint"))
    assert tuple(narrow.size_report(df, small, ["s"]).first()) == (21, 10, 2.1)
    assert not narrow.is_big(df) and narrow.is_big(df, 20)
