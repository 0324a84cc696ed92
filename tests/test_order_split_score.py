import random

import pytest
from pyspark.sql import functions as F

from colweave.operators import order, score, split
from conftest import plan_of


@pytest.mark.parametrize("keys", [
    list(range(1, 30_001)),
    random.Random(1).sample(range(-10**12, 10**12), 5000),
    [-(2**40), 0, 2**40, 2**40 + 1],
    [7],
])
def test_rank_cutoffs(spark, keys):
    df = spark.createDataFrame([(k,) for k in random.Random(2).sample(keys, len(keys))], "line_id bigint")
    ranks = sorted({1, 2, len(keys) // 3 or 1, len(keys) // 2 or 1, len(keys)})
    ordered = sorted(keys)
    assert order.rank_cutoffs(df, ranks) == {r: ordered[min(r, len(keys)) - 1] for r in ranks}
    assert order.rank_cutoffs(df, [0, len(keys) + 5]) == {0: None, len(keys) + 5: ordered[-1]}


def test_row_prefix_long_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("id * 2 line_id", "id v").write.parquet(path)
    got = order.row_prefix(spark.read.parquet(path), 20_000)
    assert got.agg(F.count("*"), F.max("line_id")).first()[:] == (20_000, 39_998)
    plan = plan_of(got)
    assert "LessThanOrEqual(line_id,39998)" in plan and "Exchange" not in plan


def test_running_sums_and_codes(spark):
    rows = [(k, random.Random(k).randint(0, 9)) for k in range(1000)]
    df = spark.createDataFrame(rows, "score bigint, neg bigint").repartition(6)
    total, want = 0, {}
    for k, n in rows:
        want[k] = total
        total += n
    got = order.running_sums(df, ["score"], {"below": "neg"})
    assert {r["score"]: r["below"] for r in got.collect()} == want
    words = [(g, f"{g}{i:03d}") for g in "ab" for i in range(0, 300, 7)]
    coded = order.dense_codes(spark.createDataFrame(words, "column string, value string").repartition(5), "column", "value")
    for g in "ab":
        ordered = sorted(w for c, w in words if c == g)
        assert {r["value"]: r["code"] for r in coded.where(F.col("column") == g).collect()} == {w: i for i, w in enumerate(ordered)}


def test_hash_split_is_stable_and_nested(spark):
    df = spark.range(40_000).withColumnRenamed("id", "line_id")
    train, test = split.split_hash(df)
    assert train.count() + test.count() == 40_000
    assert abs(test.count() / 40_000 - 0.25) < 0.01
    assert "Exchange" not in plan_of(test)
    again = split.split_hash(df.repartition(9))[1]
    assert again.exceptAll(test).isEmpty() and test.exceptAll(again).isEmpty()
    inner_train, inner_test = split.split_hash(train, salt=split.INNER)
    assert abs(inner_test.count() / train.count() - 0.25) < 0.02 and not inner_train.isEmpty()


def test_ordered_split(spark):
    df = spark.range(1001).selectExpr("id * 5 - 2000 line_id")
    train, test = split.split_ordered(df)
    assert (train.count(), test.count()) == (750, 251)
    assert train.agg(F.max("line_id")).first()[0] < test.agg(F.min("line_id")).first()[0]


def test_folds_are_even_also_inside_a_split(spark):
    train, _ = split.split_hash(spark.range(30_000).withColumnRenamed("id", "line_id"))
    sizes = [r["count"] for r in split.with_fold(train, 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) / min(sizes) < 1.1
    with pytest.raises(ValueError):
        split.with_fold(train, 1)


def _brute_auc(rows):
    pos = [s for t, s in rows if t == 1]
    neg = [s for t, s in rows if t != 1]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("one_window", [100_000, 0])
def test_auc_against_all_pairs(spark, one_window):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(600)]
    df = spark.createDataFrame(rows, "target int, prediction double")
    got = score.auc(df, one_window=one_window).first()[0]
    assert got == pytest.approx(_brute_auc(rows), abs=1e-12)
    flipped = score.auc(df.withColumn("prediction", -F.col("prediction")), one_window=one_window).first()[0]
    assert got + flipped == pytest.approx(1.0, abs=1e-12)


def test_auc_edges(spark):
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.5)], "target int, prediction double")
    assert score.auc(tied).first()[0] == 0.5
    assert score.auc(tied.where("target = 1")).first()[0] is None
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "target int, prediction int")
    want = score.auc(labels).first()[0]
    assert score.auc_of_labels(labels).first()[0] == pytest.approx(want)


def test_error_scores(spark):
    truth = spark.createDataFrame([(1, 1.0), (2, 2.0)], "line_id bigint, target double")
    guess = spark.createDataFrame([(2, 5.0), (1, 5.0)], "line_id bigint, prediction double")
    both = score.align(truth, guess)
    assert score.rmse(both).first()[0] == pytest.approx(12.5**0.5)
    assert score.neg_mse(both).first()[0] == -12.5
    assert score.rmse_two_columns(truth, guess).first()[0] == pytest.approx(12.5**0.5 / 2**0.5)


@pytest.mark.parametrize("extra", ["truth", "guess"])
def test_align_refuses_unmatched_keys(spark, extra):
    truth = spark.range(3 + (extra == "truth")).selectExpr("id line_id", "1.0D target")
    guess = spark.range(3 + (extra == "guess")).selectExpr("id line_id", "1.0D prediction")
    with pytest.raises(Exception, match="same keys"):
        score.rmse(score.align(truth, guess)).collect()
    assert score.align(truth, guess, strict=False).count() == 3


def test_align_sees_repeated_and_missing_keys_under_any_action(spark):
    truth = spark.createDataFrame([(1, 1.0), (2, 2.0)], "line_id bigint, target double")
    for rows in ([(1, 1.0)], [(1, 1.0), (2, 2.0), (2, 3.0)], [(1, 1.0), (3, 2.0)], [(1, 1.0), (2, 2.0), (None, 2.0)]):
        guess = spark.createDataFrame(rows, "line_id bigint, prediction double")
        with pytest.raises(Exception, match="same keys"):
            score.align(truth, guess).count()


def test_auc_leaves_out_rows_without_label_or_score(spark):
    rows = [(1, 0.9), (0, 0.1), (None, 0.5), (1, None)]
    assert score.auc(spark.createDataFrame(rows, "target int, prediction double")).first()[0] == 1.0


def test_keys_with_only_high_bits_and_without_value_are_split(spark):
    high = spark.range(4000).select((F.col("id") * (1 << 31)).alias("line_id"))
    train, test = split.split_hash(high)
    assert 0.2 < test.count() / 4000 < 0.3
    loose = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "line_id bigint")
    for train, test in (split.split_hash(loose), split.split_ordered(loose)):
        assert train.count() + test.count() == 5
