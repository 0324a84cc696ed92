"""Scores as one-row tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colweave.operators.order import running_sums
from colweave.schema import KEY, LABEL, col
from colweave.session import settle

PREDICTION = "prediction"
ONE_WINDOW_SCORES = 100_000  # distinct scores that one sorted window may hold


def align(truth: DataFrame, prediction: DataFrame, key: str = KEY, strict: bool = True) -> DataFrame:
    """(key, target, prediction) joined by key.

    ``strict`` fails the job if a key stands on one side only, or twice on a
    side: both sides are reduced to one row per key (which the join needs
    anyway), and the check is a filter, so no later step can prune it away.
    """
    t = truth.select(col(key).alias("_kt"), col(LABEL).alias(LABEL))
    p = prediction.select(col(key).alias("_kp"), col(PREDICTION).alias(PREDICTION))
    match = F.col("_kt") == F.col("_kp")
    if not strict:
        return t.join(p, match, "inner").select(F.col("_kt").alias(key), LABEL, PREDICTION)
    t = t.groupBy("_kt").agg(F.first(LABEL).alias(LABEL), F.count(F.lit(1)).alias("_nt"))
    p = p.groupBy("_kp").agg(F.first(PREDICTION).alias(PREDICTION), F.count(F.lit(1)).alias("_np"))
    both = t.join(p, match, "full_outer")
    paired = F.coalesce((F.col("_nt") == 1) & (F.col("_np") == 1), F.lit(False))
    wrong = F.raise_error(F.lit("truth and prediction do not hold the same keys, each once"))
    return both.where(F.when(paired, F.lit(True)).otherwise(wrong.cast("boolean"))).select(
        F.col("_kt").alias(key), LABEL, PREDICTION
    )


def _squared(t: str, p: str) -> Column:
    gap = col(t) - col(p)
    return gap * gap


def rmse(df: DataFrame, target: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    return df.agg(F.sqrt(F.avg(_squared(target, prediction))).alias("rmse"))


def neg_mse(df: DataFrame, target: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Negative mean squared error: higher is better."""
    return df.agg((-F.avg(_squared(target, prediction))).alias("neg_mse"))


def rmse_two_columns(truth: DataFrame, prediction: DataFrame, key: str = KEY) -> DataFrame:
    """Root of the mean squared gap over key and target together.

    Rows are joined by key, so the key gaps are zero and the value is the plain
    score divided by the root of two.
    """
    joined = align(truth, prediction, key)
    return joined.agg(F.sqrt(F.avg(_squared(LABEL, PREDICTION)) / 2).alias("rmse_two_col"))


def auc(df: DataFrame, target: str = LABEL, score: str = PREDICTION, one_window: int = ONE_WINDOW_SCORES) -> DataFrame:
    """Area under the ROC curve, ties at half weight; null when a class is absent. Rows without label or score are left out.

    Rows are first reduced to one per distinct score (map-side combined, so a
    score shared by a third of the rows is one row). A small score table takes
    one sorted window; a large one takes range-partitioned running sums.
    """
    positive = F.sum(F.when(col(target) == 1, 1).otherwise(0)).alias("pos")
    negative = F.sum(F.when(col(target) == 1, 0).otherwise(1)).alias("neg")
    known = df.where(col(target).isNotNull() & col(score).isNotNull())
    by_score = known.groupBy(col(score).alias("score")).agg(positive, negative)
    written = settle(by_score, "scores")
    if written.count() <= one_window:
        below = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
        ranked = written.withColumn("neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    else:
        ranked = running_sums(written, ["score"], {"neg_below": "neg"})
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


def auc_of_labels(df: DataFrame, target: str = LABEL, label: str = PREDICTION) -> DataFrame:
    """The same area for 0/1 predictions: (true positive rate + true negative rate) / 2, one pass."""
    t, p = col(target) == 1, col(label) == 1
    hit = F.try_divide(F.count_if(t & p), F.count_if(t))
    miss = F.try_divide(F.count_if(~t & ~p), F.count_if(~t))
    return df.agg(((hit + miss) / 2).alias("auc"))
