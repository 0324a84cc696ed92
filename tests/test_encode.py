import random

import pytest
from pyspark.sql import functions as F

from colweave.operators import encode
from colweave.operators.profile import profile
from conftest import plan_of


def _with_values(spark, n, missing=False):
    rows = [(i, f"v{i % n:02d}") for i in range(n * 3)] + ([(999, None)] if missing else [])
    return spark.createDataFrame(rows, "line_id bigint, string_0 string")


@pytest.mark.parametrize(("n", "missing", "encoded"), [
    (2, False, False), (3, False, True), (20, False, True), (21, False, False), (2, True, True), (20, True, False),
])
def test_value_bounds(spark, n, missing, encoded):
    fitted = encode.fit_onehot(_with_values(spark, n, missing))
    assert ("string_0" in fitted.values) is encoded
    if encoded:
        assert len(fitted.values["string_0"]) == n + missing


def test_indicators(spark):
    df = _with_values(spark, 2, missing=True)
    out = encode.fit_onehot(df).apply(df)
    assert out.columns[2:] == ["onehot_string_0=v00", "onehot_string_0=v01", "onehot_string_0=nan"]
    sums = {r["line_id"]: sum(r[2:]) for r in out.collect()}
    assert sums.pop(999) == 0 and set(sums.values()) == {1}
    assert out.agg(F.max("`onehot_string_0=nan`")).first()[0] == 0


def test_unseen_value_is_all_zero(spark):
    fitted = encode.fit_onehot(_with_values(spark, 3))
    new = spark.createDataFrame([(1, "other"), (2, "v01")], "line_id bigint, string_0 string")
    assert [sum(r[2:]) for r in fitted.apply(new).orderBy("line_id").collect()] == [0, 1]


def test_odd_values_are_quoted(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["it's", "a\\b", "c`d", "e\"f"])], "line_id bigint, string_0 string")
    out = encode.fit_onehot(df).apply(df)
    assert [sum(r[2:]) for r in out.collect()] == [1] * 4
    assert len(out.columns) == 6


def test_number_and_timestamp_values(spark):
    df = spark.range(30).selectExpr(
        "id line_id", "id % 3 number_a", "(id % 4) / 4 number_b", "timestamp_ntz'2020-01-01' + make_dt_interval(id % 5) datetime_0"
    )
    fitted = encode.fit_onehot(df)
    assert {c: len(v) for c, v in fitted.values.items()} == {"number_a": 3, "number_b": 4, "datetime_0": 5}
    sums = {sum(r[4:]) for r in fitted.apply(df).collect()}
    assert sums == {3}


def _profiles(spark, sizes):
    df = spark.range(200).selectExpr(*[f"id % {n} as number_{i}" for i, n in enumerate(sizes)])
    return profile(df)


def test_budget_order_and_stop(spark):
    profiles = _profiles(spark, [50, 3, 101, 10, 2])
    assert encode.choose_by_budget(profiles, 5) == {"number_1": 3, "number_3": 10, "number_0": 50}
    # 5 + 3 = 8, then 10 more fit into 18 only up to two columns short of it
    assert encode.choose_by_budget(profiles, 5, most_columns=18) == {"number_1": 3, "number_3": 8}
    assert encode.choose_by_budget(profiles, 5, most_columns=17) == {"number_1": 3}


def test_width_cap(spark):
    profiles = _profiles(spark, [50, 3, 101, 10])
    assert encode.choose_by_width(profiles, 4, most_columns=60) == {"number_0": 50, "number_1": 3}
    assert encode.choose_by_width(profiles, 4, big=True) == {}


def _skewed(spark):
    rnd = random.Random(5)
    values = ["hot"] * 2000 + [f"v{rnd.randint(0, 1500)}" for _ in range(3000)] + [None] * 500
    rnd.shuffle(values)
    return spark.createDataFrame(list(enumerate(values)), "line_id bigint, id_0 string").withColumn("number_0", F.lit(1.0))


def test_frequency_paths_agree_on_a_hot_value(spark):
    df = _skewed(spark)
    fitted = encode.fit_frequency(df)
    assert fitted.sizes["id_0"][0] == df.select("id_0").distinct().count() - 1
    counts: dict = {}
    for r in df.collect():
        counts[r["id_0"]] = counts.get(r["id_0"], 0) + 1
    new = df.unionByName(spark.createDataFrame([(9999, "unseen", 1.0)], df.schema))
    want = {r["line_id"]: counts[r["id_0"]] if r["id_0"] in counts and r["id_0"] else -1 for r in new.collect()}
    small, large = fitted.apply(new), fitted.apply(new, most_rows=10)
    assert {r["line_id"]: r["id_0"] for r in small.collect()} == want
    assert {r["line_id"]: r["id_0"] for r in large.collect()} == want
    assert small.columns == large.columns == df.columns
    assert "SortMergeJoin" not in plan_of(small)


def test_hot_missing_and_unseen_rows_are_spread(spark):
    values = F.when(F.col("id") % 8 < 4, "hot").when(F.col("id") % 8 < 6, "unseen").when(F.col("id") % 8 < 7, F.concat(F.lit("v"), F.col("id")))
    df = spark.range(16_000).select(F.col("id").alias("line_id"), values.alias("id_0"))
    fitted = encode.fit_frequency(df.where("id_0 != 'unseen'"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        coded = fitted.apply(df, most_rows=0, hot_rows=200)
        sizes = [r["count"] for r in coded.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
        assert {r["id_0"]: r["count"] for r in coded.groupBy("id_0").count().collect()} == {8000: 8000, -1: 6000, 1: 2000}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequency_without_text_columns(spark):
    df = spark.range(3).selectExpr("id line_id", "1.0D number_0")
    assert encode.fit_frequency(df).apply(df).collect() == df.collect()


def test_each_fit_starts_afresh(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x")], "line_id bigint, id_0 string")
    b = spark.createDataFrame([(1, "x")], "line_id bigint, id_0 string")
    encode.fit_frequency(a)
    assert encode.fit_frequency(b).apply(b).first()["id_0"] == 1


def test_code_equal_to_another_value_is_not_replaced_again(spark):
    df = spark.createDataFrame([(1, "2"), (2, "2"), (3, "x"), (4, "x"), (5, "x")], "line_id bigint, id_0 string")
    got = [r["id_0"] for r in encode.fit_frequency(df).apply(df).orderBy("line_id").collect()]
    assert got == [2, 2, 3, 3, 3]


def test_dictionary_codes(spark):
    words = [f"w{i:02d}" for i in range(40)]
    rnd = random.Random(1)
    rows = [(i, rnd.choice(words), f"u{i}") for i in range(400)] + [(400, None, "u400")]
    df = spark.createDataFrame(rows, "line_id bigint, string_0 string, id_0 string")
    fitted = encode.fit_dictionary(df)
    assert list(fitted.sizes) == ["string_0"]  # id_0 has one value per row
    order = sorted({r[1] for r in rows if r[1]})
    got = {r["line_id"]: r["string_0"] for r in fitted.apply(df).collect()}
    assert got == {i: order.index(w) if w else -1 for i, w, _ in rows}


def test_dictionary_rule_is_exact_near_the_limit(spark):
    # 5000 of 10,000 rows are distinct: not below half; one fewer is
    df = spark.range(10_000).selectExpr(
        "id line_id", "concat('a', id % 5000) string_a", "concat('b', least(id % 5000, 4998)) string_b", "uuid() string_u"
    )
    assert list(encode.fit_dictionary(df).sizes) == ["string_b"]


def test_hot_values_of_all_large_columns_come_from_one_pass(spark, monkeypatch):
    hot = lambda k: F.when(F.col("id") % 8 < 4, f"hot{k}").when(F.col("id") % 8 < 6, f"new{k}").otherwise(F.concat(F.lit("v"), F.col("id")))
    df = spark.range(16_000).select(F.col("id").alias("line_id"), *[hot(k).alias(f"id_{k}") for k in range(4)])
    fitted = encode.fit_frequency(df.where("id_0 != 'new0'"))
    passes = []
    aggregate = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: (passes.append(a), aggregate(self, *a))[1])
    found = fitted._hot(df, [f"id_{k}" for k in range(4)], 500)
    assert len(passes) == 1 and len(passes[0]) == 4
    for k in range(4):
        names = spark.createDataFrame([(f"hot{k}",), (f"new{k}",)], "v string").select(F.xxhash64("v").alias("h"))
        want = {r.h for r in names.collect()}
        got = {r.h: r.parts for r in found[f"id_{k}"].collect()}
        assert set(got) == want and got[min(got, key=lambda h: got[h])] >= 8
    coded = fitted.apply(df, most_rows=0, hot_rows=500)
    assert [{r[0]: r[1] for r in coded.groupBy(f"id_{k}").count().collect()} for k in range(4)] == [{8000: 8000, -1: 4000, 1: 4000}] * 4


def test_a_summary_finds_every_value_of_a_thousandth_of_the_rows(spark):
    rnd = random.Random(9)
    values = [f"h{k}" for k in range(30) for _ in range(120 + k)] + [f"r{rnd.randint(0, 10**9)}" for _ in range(60_000)]
    rnd.shuffle(values)
    df = spark.createDataFrame(list(enumerate(values)), "line_id bigint, id_0 string").repartition(7)
    fitted = encode.fit_frequency(df)
    hashes = {r.h for r in spark.createDataFrame([(f"h{k}",) for k in range(30)], "v string").select(F.xxhash64("v").alias("h")).collect()}
    assert {r.h for r in fitted._hot(df, ["id_0"], 100)["id_0"].collect()} >= hashes
