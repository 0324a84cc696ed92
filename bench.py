"""Headline timings: ``BENCH_SF_DIR=... BENCH_CPUS=... python bench.py`` prints one JSON line.

Stages carry the names of the published run they compare with. Every stage
computes all its output columns for all rows (no-op sink) unless its result is
a small table by nature. The stages first run once, untimed, on the smallest
tables (``BENCH_WARM_DIR``), so that the timings leave out the start of the JVM.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave import tables
from colweave.functions import dates
from colweave.operators import encode, nulls, profile, project, scale, score, select, split
from colweave.plans import models, pipeline
from colweave.session import local_session, scratch_path
from colweave.sources import scan, sinks

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark, folder: str) -> dict[str, Callable[[], object]]:
    csv = scratch_path(spark, "bench-csv")
    tables.lineitem_features(spark, folder).withColumn("line_id", F.xxhash64("*")).write.option("header", True).csv(csv)
    lines = lambda: tables.lineitem_features(spark, folder)
    dated = lambda: dates.expand_six(lines())
    orders = lambda: tables.orders_features(spark, folder)
    wide = lambda: tables.wide_orders(spark, folder)
    state: dict[str, object] = {}

    def many_dates() -> DataFrame:
        text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
        return tables.read(spark, folder, "orders").select(*[text.alias(f"datetime_{i}") for i in range(90)])

    def train_linear() -> None:
        train, state["test"] = split.split_hash(orders())
        state["linear"] = pipeline.train(train, models.REGRESSION, models.ridge, pipeline.ONEHOT)

    def train_boosting() -> None:
        train, state["test"] = split.split_hash(orders())
        state["boost"] = pipeline.train(train, models.REGRESSION, models.boosted(models.REGRESSION, 20), pipeline.FREQUENCY)

    def predict(name: str) -> Callable[[], None]:
        return lambda: sinks.save_predictions(state[name].predict(state["test"]), scratch_path(spark, "bench-prediction"))

    def train_classes() -> None:
        train, state["event_test"] = split.split_hash(tables.events_features(spark, folder))
        state["logistic"] = pipeline.train(train, models.CLASSIFICATION, models.logistic, pipeline.ONEHOT)

    return {
        "read_dataset": lambda: run(scan.scan_csv(spark, csv)),
        "features_from_datetime": lambda: run(dated()),
        "features_from_90_datetimes": lambda: run(dates.expand_six(many_dates())),
        "missing_values": lambda: run(nulls.FillPolicy.fit(lines()).apply(lines())),
        "categorical_onehot": lambda: run(encode.fit_onehot(dated()).apply(dated())),
        "categorical_frequency": lambda: run(encode.fit_frequency(lines()).apply(lines())),
        "drop_constant": lambda: run(profile.drop_constant(dated())[0]),
        "drop_constant_wide": lambda: run(profile.drop_constant(wide())[0]),
        "distinct_counts": lambda: run(profile.distinct_counts(lines())),
        "correlation_wide": lambda: select.correlated_columns(
            nulls.fill_constant(wide()), project.by_prefix(wide().columns)
        ),
        "scaling": lambda: run(
            scale.Scaler.fit(lines(), project.by_prefix(lines().columns)).apply(lines())
        ),
        "train_linear": train_linear,
        "predict_linear": predict("linear"),
        "train_boosting": train_boosting,
        "predict_boosting": predict("boost"),
        "train_classes": train_classes,
        "score_rmse": lambda: score.rmse(state["linear"].predict(state["test"])).first(),
        "score_auc": lambda: score.auc(state["logistic"].predict(state["event_test"], probability=True)).first(),
    }


def main() -> None:
    spark = local_session(CPUS, "colweave-bench", **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.environ.get("BENCH_WARM_DIR", f"{os.path.dirname(FOLDER)}/sf0.001")
    for stage in stages(spark, warm).values() if os.path.isdir(warm) else []:
        stage()
    seconds = {}
    for name, stage in stages(spark, FOLDER).items():
        start = time.monotonic()
        stage()
        seconds[name] = round(time.monotonic() - start, 3)
    found = re.search(r"sf([0-9.]+)$", FOLDER)
    print(json.dumps({
        "metric": "total stage seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else FOLDER,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
