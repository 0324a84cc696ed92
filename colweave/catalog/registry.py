"""One query per operator, each over whole tables.

Every function takes (spark, folder) and gives a DataFrame; ``oracle`` holds
the same result as SQL where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave import tables
from colweave.functions import dates, scalars
from colweave.operators import (
    encode,
    leading,
    narrow,
    neighbours,
    nulls,
    profile,
    project,
    scale,
    score,
    select,
    sketched,
    split,
    target,
)
from colweave.operators.order import row_prefix
from colweave.plans import models, pipeline, response, ridge, search, stack
from colweave.schema import Roles, quoted
from colweave.session import scratch_path, settle
from colweave.sources import scan, sinks, synth

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Boosting rounds of the registered model queries; the library default is 100.
ROUNDS = 10


def query(function: Query | None = None, *, name: str | None = None):
    """Register a query under its own name or another one."""
    if function is None:
        return lambda f: query(f, name=name)

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(spark, folder.rstrip("/"))

    _QUERIES[name or function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 6, *names: str) -> DataFrame:
    """Round double columns, and turn -0.0 into 0.0."""
    doubles = [n for n, t in df.dtypes if t in ("double", "float") and (not names or n in names)]
    return df.selectExpr(*[
        f"round(cast({quoted(c)} as double), {digits}) + 0.0D as {quoted(c)}" if c in doubles else quoted(c)
        for c in df.columns
    ])


orders = tables.orders_features
events = tables.events_features


def expanded(spark: SparkSession, folder: str) -> DataFrame:
    return dates.expand_six(orders(spark, folder))


ORDER_NUMBERS = ["number_0", "number_1", "number_2"]
DATE_NUMBERS = [dates.part_name(p, "datetime_0") for p in dates.SIX_PARTS]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ---------------------------------------------------------------- scans and sinks


def _orders_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "orders-csv")
    orders(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    return path


@query
def scan_csv(spark, folder):
    return scan.scan_csv(spark, _orders_csv(spark, folder))


@query
def scan_limit(spark, folder):
    return scan.limited(orders(spark, folder), 500)


@query
def scan_columns(spark, folder):
    return scan.limited(orders(spark, folder), None, ["line_id", "number_0", "string_1", "no_such_column"])


@query
def scan_bounded(spark, folder):
    return scan.scan_bounded(spark, _orders_csv(spark, folder))


@query
def scan_csv_headers(spark, folder):
    """Two folders of files under one path, whose headers name the same columns in another order."""
    path, df = scratch_path(spark, "orders-csv"), orders(spark, folder)
    even = F.col("line_id") % 2 == 0
    df.where(even).write.option("header", True).option("escape", '"').csv(f"{path}/a")
    df.where(~even).select(*reversed(df.columns)).write.option("header", True).option("escape", '"').csv(f"{path}/b")
    return scan.scan_csv(spark, path).select(*df.columns)


@query
def scan_csv_quoted(spark, folder):
    """Whole texts with quotes and line breaks, written and read again."""
    path = scratch_path(spark, "texts-csv")
    texts = tables.read(spark, folder, "documents").select(F.col("doc_id").alias("line_id"), F.col("text").alias("string_0"))
    texts.write.option("header", True).option("escape", '"').option("quoteAll", True).option("lineSep", "\n").csv(path)
    return scan.scan_csv(spark, path, multi_line=True)


@query
def estimate_rows(spark, folder):
    """How far the estimate from the first lines is off: within a tenth of the rows, and of a row's bytes as written."""
    path = _orders_csv(spark, folder)
    found, rows = scan.estimate(spark, path).first(), orders(spark, folder).count()
    size = scan.file_bytes(spark, path) / rows
    near = abs(found["rows"] - rows) <= rows / 10, abs(found["row_size"] - size) <= size / 10
    return spark.createDataFrame([(rows, *near)], "rows bigint, rows_near boolean, row_size_near boolean")


@query
def sink_prediction(spark, folder):
    path = scratch_path(spark, "prediction")
    sinks.save_predictions(tables.with_prediction(orders(spark, folder)), path)
    return spark.read.schema("line_id bigint, prediction double").option("header", True).csv(path)


def _order_metrics(spark, folder):
    """Three measures per order status."""
    return orders(spark, folder).groupBy(F.col("string_1").alias("dataset")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("target"), 6).alias("score")
    )


def _event_metrics(spark, folder):
    """Four measures per event type."""
    return tables.read(spark, folder, "events").groupBy(F.col("event_type").alias("dataset")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"), F.max("value").alias("top")
    )


@query
def sink_metrics(spark, folder):
    path = scratch_path(spark, "metrics")
    for part in (_order_metrics(spark, folder), _order_metrics(spark, folder)):
        sinks.append_metrics(part, path)
    return spark.read.schema("dataset string, rows bigint, score double").option("header", True).csv(path)


def _saved_metrics(spark, folder):
    root = scratch_path(spark, "metrics-by-schema")
    sinks.save_metrics(_order_metrics(spark, folder), root, "runs", "run-1")
    sinks.save_metrics(_event_metrics(spark, folder), root, "runs", "run-1")
    sinks.save_metrics(_event_metrics(spark, folder), root, "runs", "run-2")
    return root


@query
def metrics_by_schema(spark, folder):
    root = _saved_metrics(spark, folder)
    stored = spark.read.option("mergeSchema", True).parquet(f"{root}/subfolder=runs")
    return stored.groupBy("schema_hash").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("run_id").alias("n_runs"))


@query
def metrics_union(spark, folder):
    return sinks.load_metrics(spark, _saved_metrics(spark, folder), "runs")


@query
def metrics_export(spark, folder):
    path = scratch_path(spark, "metrics-export")
    sinks.export_metrics(sinks.union_metrics([_order_metrics(spark, folder), _event_metrics(spark, folder)]), path)
    layout = "dataset string, rows bigint, score double, users bigint, top double"
    return spark.read.schema(layout).option("header", True).option("sep", ";").csv(path)


def _one_feature(spark, folder):
    return orders(spark, folder).select("line_id", "number_1", "target")


def _ridge_scorer(train_table):
    return pipeline.train(train_table, models.REGRESSION, models.ridge, pipeline.FREQUENCY)


@query
def model_roundtrip(spark, folder):
    df = _one_feature(spark, folder)
    path = scratch_path(spark, "model")
    pipeline.save(_ridge_scorer(df), path)
    return rounded(pipeline.load(spark, path).predict(df).select("line_id", "prediction"), 5)


@query
def synth_table(spark, folder):
    return synth.noise_table(orders(spark, folder), 6)


@query
def inject_nulls(spark, folder):
    blocks = {"number_1": (3000, 5000), "number_0": (4000, 6000), "string_1": (5000, 8000)}
    return synth.inject_missing(orders(spark, folder), blocks)


# ---------------------------------------------------------------- projections


@query
def split_label(spark, folder):
    features, label = project.split_label(orders(spark, folder))
    return features.select("line_id", *ORDER_NUMBERS).join(label, "line_id")


@query
def select_prefix(spark, folder):
    df = orders(spark, folder)
    return project.pick(df, project.by_prefix(df.columns), ["line_id"])


@query
def select_deny(spark, folder):
    df = orders(spark, folder)
    return project.pick(df, project.by_denial(df.columns, ["string_1"]), ["line_id"])


@query
def replay_columns(spark, folder):
    return project.pick(orders(spark, folder), ["number_2", "number_0", "string_0"], ["line_id"])


@query
def select_dtype(spark, folder):
    df = orders(spark, folder)
    return project.pick(df, project.by_dtype(df, "double"), ["line_id"])


@query
def append_block(spark, folder):
    df = orders(spark, folder).select("line_id", "number_0", "number_1")
    return project.append_block(df, {
        "number_sum": F.col("number_0") + F.col("number_1"),
        "number_gap": F.col("number_0") - F.col("number_1"),
    })


@query
def guard_min_rows(spark, folder):
    df = orders(spark, folder)
    seen = project.guard_rows(df, 2)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(seen).cast("bigint").alias("rows_checked"))


@query
def row_prefix_long(spark, folder):
    df = orders(spark, folder)
    return row_prefix(df, df.count() * 4 // 5)


@query(name="row_prefix")
def row_prefix_short(spark, folder):
    """The first 500 orders by key."""
    return row_prefix(orders(spark, folder), 500)


@query
def filter_profile(spark, folder):
    counts = profile.distinct_counts(orders(spark, folder).drop("line_id", "target"))
    return counts.where((F.col("n_distinct") > 2) & (F.col("n_distinct") <= 20))


@query
def column_roles(spark, folder):
    roles = Roles({"number_1": "categorical", "target": "output", "id_0": "ignore"})
    df = orders(spark, folder)
    return encode.frequency_table(df, encode.encoded_columns(df.columns, roles))


# ---------------------------------------------------------------- missing values


@query
def any_null(spark, folder):
    with_some = profile.any_missing(orders(spark, folder)).withColumn("tab", F.lit("orders_features"))
    without = profile.any_missing(tables.read(spark, folder, "lineitem")).withColumn("tab", F.lit("lineitem"))
    return with_some.unionByName(without)


@query
def fill_const(spark, folder):
    return nulls.fill_constant(orders(spark, folder))


@query
def fill_mean(spark, folder):
    df = orders(spark, folder)
    return nulls.fill_values(df, nulls.means(df, [*ORDER_NUMBERS, "number_const", "number_null"]))


@query
def fill_mode(spark, folder):
    df = orders(spark, folder)
    return nulls.fill_values(df, nulls.modes(df, [*ORDER_NUMBERS, "number_const", "number_null", "string_0"]))


@query
def fill_max(spark, folder):
    df = orders(spark, folder)
    return nulls.fill_values(df, nulls.maxima(df, [*ORDER_NUMBERS, "number_const", "number_null"]))


@query
def fill_replay(spark, folder):
    train, test = split.split_hash(orders(spark, folder))
    return nulls.FillPolicy.fit(train).apply(test)


def _hollow_test(spark, folder):
    """Training rows without a missing value, test rows with some."""
    train, test = split.split_hash(orders(spark, folder).select("line_id", "number_1", "number_2"))
    hollow = F.when(F.col("line_id") % 3 != 0, F.col("number_1"))
    return train, test.withColumn("number_1", hollow)


@query
def fill_replay_mean(spark, folder):
    train, test = _hollow_test(spark, folder)
    return rounded(nulls.FillPolicy.fit(train).apply(test), 9)


@query
def fill_replay_self(spark, folder):
    train, test = _hollow_test(spark, folder)
    return rounded(nulls.FillPolicy.fit(train, stats="self").apply(test), 9)


# ---------------------------------------------------------------- dates and scalars


def _as_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query
def parse_dt_null(spark, folder):
    parsed = dates.parse_date(F.col("datetime_0"))
    return orders(spark, folder).select("line_id", _as_text(parsed).alias("parsed"))


@query
def parse_dt_sentinel(spark, folder):
    parsed = dates.parse_date_or_empty(F.col("datetime_0"))
    return orders(spark, folder).select("line_id", _as_text(parsed).alias("parsed"))


def _part_query(part: str) -> Query:
    parse = dates.parse_date_or_empty if part == "year" else dates.parse_date

    def run(spark: SparkSession, folder: str) -> DataFrame:
        value = dates.PARTS[part](parse(F.col("datetime_0")))
        return orders(spark, folder).select("line_id", value.alias(part))

    run.__name__ = f"dt_{part}"
    return query(run)


for _part in dates.PARTS:
    _part_query(_part)


@query
def datetime_expand6(spark, folder):
    return expanded(spark, folder).select("line_id", *DATE_NUMBERS)


@query
def datetime_expand6_zone(spark, folder):
    """The same parts in a session of another zone, whose clock skips an hour a year."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = orders(spark, folder)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # Expressions take the zone when they are resolved, which is here.
        return dates.expand_six(df).select("line_id", *DATE_NUMBERS)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@query
def datetime_expand5(spark, folder):
    names = [dates.part_name(p, "datetime_0") for p in dates.FIVE_PARTS]
    return dates.expand_five(orders(spark, folder)).select("line_id", *names)


@query
def round_scale(spark, folder):
    return orders(spark, folder).select("line_id", scalars.scale_and_round(F.col("target")).alias("scaled"))


@query
def feature_arith(spark, folder):
    df = tables.read(spark, folder, "lineitem")
    a, b, c, d = (F.col(n) for n in LINE_NUMBERS)
    return df.select(
        "l_orderkey", "l_linenumber",
        scalars.ratio(a + b, c * d).alias("share"), (scalars.ratio(a, b, 1e-16) + c * d).alias("mix"),
    )


@query
def md5_upper(spark, folder):
    return tables.read(spark, folder, "documents").select("doc_id", scalars.md5_upper(F.col("text")).alias("digest"))


@query
def zero_pad(spark, folder):
    return orders(spark, folder).select("line_id", scalars.zero_pad(F.col("line_id")).alias("padded"))


@query
def run_id(spark, folder):
    named = _order_metrics(spark, folder).withColumn("run_id", scalars.run_id())
    return named.agg(F.sum("rows").alias("rows"), F.countDistinct("run_id").alias("ids"), F.max(F.length("run_id")).alias("length"))


# ---------------------------------------------------------------- narrower types


@query
def narrow_int(spark, folder):
    df = tables.read(spark, folder, "lineitem")
    return narrow.fit_integers(df).table(df)


@query
def narrow_apply(spark, folder):
    df = tables.read(spark, folder, "lineitem").select("l_linenumber", *LINE_NUMBERS)
    small = narrow.fit_floats(df, ["l_quantity", "l_discount"]).apply(df)
    return narrow.fit_integers(small).apply(small)


@query
def narrow_float(spark, folder):
    df = tables.read(spark, folder, "lineitem")
    return narrow.fit_floats(df).table(df)


@query
def narrow_unsigned(spark, folder):
    df = tables.read(spark, folder, "lineitem").withColumn("signed", F.col("l_suppkey") - 50)
    return narrow.fit_integers(df, unsigned=True).table(df)


@query
def dictionary_encode(spark, folder):
    df = orders(spark, folder).select("line_id", "string_0", "string_1", "id_0")
    return encode.fit_dictionary(df).apply(df)


@query
def narrow_report(spark, folder):
    df = tables.read(spark, folder, "lineitem")
    dictionary = encode.fit_dictionary(df)
    small = narrow.fit_floats(df).apply(narrow.fit_integers(df).apply(df))
    return narrow.size_report(df, small, list(dictionary.sizes))


@query
def transform_ds(spark, folder):
    df = orders(spark, folder).drop("datetime_0", "id_0")
    return pipeline.compact(df)


@query
def dtype_counts(spark, folder):
    return project.type_counts(orders(spark, folder))


@query
def is_big(spark, folder):
    return narrow.big_table(tables.read(spark, folder, "lineitem"))


# ---------------------------------------------------------------- encoders


def _with_onehot(df: DataFrame, fitted: encode.OneHot) -> DataFrame:
    return project.pick(fitted.apply(df), fitted.names(), ["line_id"])


@query
def onehot_fit(spark, folder):
    df = orders(spark, folder)
    return _with_onehot(df, encode.fit_onehot(df))


@query
def onehot_budget(spark, folder):
    df = nulls.fill_constant(orders(spark, folder))
    return _with_onehot(df, encode.fit_onehot_budget(df, most_columns=27))


@query
def onehot_width_cap(spark, folder):
    df = orders(spark, folder).select("line_id", "number_1", "string_0", "string_1", "number_2", "target")
    return _with_onehot(df, encode.fit_onehot_width_cap(df, most_columns=25))


@query
def onehot_replay(spark, folder):
    train, test = split.split_hash(orders(spark, folder))
    fitted = encode.fit_onehot(train, ["string_0", "string_1", "number_1"])
    unseen = F.when(F.col("line_id") % 10 == 0, F.lit("no such value")).otherwise(F.col("string_0"))
    return _with_onehot(test.withColumn("string_0", unseen), fitted)


@query
def freq_fit(spark, folder):
    df = orders(spark, folder)
    return encode.frequency_table(df, encode.encoded_columns(df.columns))


def _frequency_replay(spark, folder, **limits):
    names = ["string_0", "string_1", "id_0"]
    train, test = split.split_hash(orders(spark, folder).select("line_id", *names))
    return encode.fit_frequency(train).apply(test, **limits)


@query
def freq_replay(spark, folder):
    return _frequency_replay(spark, folder)


@query
def freq_replay_shuffled(spark, folder):
    """The same result by the path that tables too large to broadcast take."""
    return _frequency_replay(spark, folder, most_rows=0)


@query
def freq_replay_skewed(spark, folder):
    """The shuffled path with half of the rows on one known value, a quarter on an unseen one, and missing ones."""
    def skewed(df):
        part = F.col("line_id") % 8
        value = F.when(part < 4, F.lit("c")).when(part < 6, F.lit("new")).when(part == 6, F.col("id_0"))
        return df.select("line_id", value.alias("id_0"))

    train, test = split.split_hash(orders(spark, folder).select("line_id", "id_0"))
    known = skewed(train).where("id_0 != 'new'")
    return encode.fit_frequency(known).apply(skewed(test), most_rows=0)


@query
def ordered_target(spark, folder):
    """Text and id columns as the mean label of the earlier rows of each value."""
    df = orders(spark, folder).select("line_id", "string_0", "string_1", "id_0", "target")
    return rounded(target.ordered_target_encode(df))


@query
def ordered_target_skewed(spark, folder):
    """Half of the rows hold one value, a quarter none."""
    part = F.col("line_id") % 8
    value = F.when(part < 4, F.lit("c")).when(part >= 6, F.col("id_0"))
    return rounded(target.ordered_target_encode(orders(spark, folder).select("line_id", value.alias("id_0"), "target")))


@query
def target_replay(spark, folder):
    """The held-out rows by the mean label of each value in the others; id_0 goes by shuffle."""
    train, test = split.split_hash(orders(spark, folder).select("line_id", "string_0", "id_0", "target"))
    return rounded(target.fit_target_means(train).apply(test.drop("target"), most_rows=5))


# ---------------------------------------------------------------- profiles and selection


@query
def drop_constant(spark, folder):
    return profile.drop_constant(orders(spark, folder))[0]


@query
def profile_distinct(spark, folder):
    return profile.distinct_counts(tables.read(spark, folder, "lineitem"))


@query
def profile_distinct_wide(spark, folder):
    df = tables.wide_orders(spark, folder).drop("line_id", "target")
    return profile.distinct_counts(df)


@query
def column_means_wide(spark, folder):
    df = tables.wide_orders(spark, folder)
    return rounded(profile.column_means(df, [c for c in df.columns if c.startswith("number_w")]), 9)


@query
def column_means(spark, folder):
    return rounded(profile.column_means(tables.read(spark, folder, "lineitem"), LINE_NUMBERS), 5)


@query
def distinct_values(spark, folder):
    return profile.distinct_values(tables.read(spark, folder, "lineitem"), "l_suppkey")


@query
def value_counts(spark, folder):
    return profile.value_counts(tables.read(spark, folder, "lineitem"), "l_partkey")


@query
def corr_matrix(spark, folder):
    return rounded(select.correlation_matrix(expanded(spark, folder), [*ORDER_NUMBERS, "number_const", *DATE_NUMBERS]))


@query
def corr_matrix_dense(spark, folder):
    df = tables.embedding_features(spark, folder)
    return rounded(select.correlation_matrix(df, project.by_prefix(df.columns)))


@query
def corr_filter(spark, folder):
    df = nulls.fill_constant(expanded(spark, folder))
    late = select.correlated_columns(df, [*ORDER_NUMBERS, "number_const", *DATE_NUMBERS])
    return spark.createDataFrame([(n,) for n in late], "column string")


@query
def corr_filter_sketched(spark, folder):
    """The correlated columns of 400 number columns, found by sketches and decided by exact sums."""
    df = tables.very_wide_orders(spark, folder, 400)
    late = sketched.correlated_columns_sketched(df, project.by_prefix(df.columns))
    return spark.createDataFrame([(n,) for n in late], "column string")


@query
def target_corr_topk(spark, folder):
    df = nulls.fill_constant(expanded(spark, folder))
    names = [*ORDER_NUMBERS, *DATE_NUMBERS]
    size = narrow.table_bytes(df).first()["bytes"]
    return rounded(select.top_by_target(df, names, select.columns_within(len(names), size, size * 2 // 5)))


@query
def variance_filter(spark, folder):
    df = tables.read(spark, folder, "lineitem").withColumn("zero", F.lit(0.0))
    kept = select.varying_columns(df, [*LINE_NUMBERS, "zero"])
    return rounded(select.variances(df, kept), 2)


@query
def mutual_info(spark, folder):
    df = nulls.fill_constant(expanded(spark, folder))
    # Cuts are found by sketch, so the estimate is stated to two digits.
    return rounded(select.mutual_information(df, [*ORDER_NUMBERS, "number_const", *DATE_NUMBERS]), 2)


@query
def mutual_info_select(spark, folder):
    df = nulls.fill_constant(expanded(spark, folder))
    table = select.mutual_information(df, [*ORDER_NUMBERS, "number_const", *DATE_NUMBERS])
    return rounded(select.above_spread(table, "mi", 0.5), 2)


@query
def mutual_info_neighbours(spark, folder):
    """The estimate from the third-nearest neighbours, a column with missing values and one of seven values."""
    return rounded(neighbours.neighbour_information(orders(spark, folder), ["number_0", "number_1"]), 5)


@query
def pca_k99(spark, folder):
    df = tables.embedding_features(spark, folder)
    found = select.principal_components(df, project.by_prefix(df.columns)).table(spark)
    total = F.abs(F.max("cumulative") - 1) < 1e-9
    kept = F.count_if(F.col("kept")) == F.count_if(F.col("cumulative") <= select.EXPLAINED_LIMIT) + 1
    return found.agg(F.count(F.lit(1)).alias("components"), total.alias("sums_to_one"), kept.alias("kept_by_rule"))


@query
def pca_two_columns(spark, folder):
    df = expanded(spark, folder).where(F.col("number_0").isNotNull())
    found = select.principal_components(df, ["number_0", "number_1"], 0.999).table(spark)
    return rounded(found)


@query
def pca_leading(spark, folder):
    """The component of most variance of the vectors, found without the matrix of their columns."""
    df = tables.embedding_features(spark, folder)
    found = leading.leading_components(df, project.by_prefix(df.columns), 1)
    return rounded(found.table(spark).select("component", "ratio"), 5)


@query
def pca_leading_columns(spark, folder):
    """All components of two columns over all rows, missing values as the mean, and each row on them up to the sign."""
    df = orders(spark, folder)
    found = leading.leading_components(df, ["number_0", "number_1"], 2, block=1)
    rows = found.apply(df, "c").selectExpr("line_id", "abs(c1) as c1", "abs(c2) as c2")
    share = found.table(spark).where("component = 1").select("ratio")
    return rounded(rows.crossJoin(F.broadcast(share)), 4)  # one row


@query
def scale_fit(spark, folder):
    df = tables.read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return rounded(scale.Scaler.fit(df, LINE_NUMBERS).apply(df))


@query
def scale_replay(spark, folder):
    train, test = split.split_hash(nulls.fill_constant(orders(spark, folder)))
    names = [*ORDER_NUMBERS, "number_const", "number_null"]
    return rounded(scale.Scaler.fit(train, names).apply(test).select("line_id", *names))


@query
def scale_float(spark, folder):
    df = tables.read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return rounded(scale.Scaler.fit(df, LINE_NUMBERS, single=True).apply(df), 3)


@query
def scale_independent(spark, folder):
    names = ["number_1", "number_2"]
    both = split.split_hash(orders(spark, folder).select("line_id", *names))
    train, test = scale.scale_each(both, names)
    return rounded(train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))))


@query
def nonconst_by_prefix(spark, folder):
    df = orders(spark, folder)
    rows = df.count()
    steps = [rows * i // 10 for i in range(1, 10)]
    names = [c for c in df.columns if c not in ("line_id", "target")]
    return profile.nonconstant_by_prefix(df, steps, names)


# ---------------------------------------------------------------- splits


@query
def split_hash(spark, folder):
    return orders(spark, folder).select("line_id", split.in_test().alias("is_test"))


@query
def split_ordered(spark, folder):
    train, test = split.split_ordered(orders(spark, folder).select("line_id"))
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query
def kfold_assign(spark, folder):
    return split.with_fold(orders(spark, folder).select("line_id"), 3)


@query
def sample_size_plan(spark, folder):
    """Speeds come from the event log: rows per second of each event type."""
    log = tables.read(spark, folder, "events")
    span = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1000000
    speeds = log.groupBy(F.col("event_type").alias("model")).agg(
        F.count(F.lit(1)).alias("rows"), span.alias("seconds"), F.countDistinct("user_id").alias("users")
    ).select("model", "rows", (F.col("rows") / F.col("seconds")).alias("fit_rows_s"), (F.col("users") / F.col("seconds")).alias("predict_rows_s"), "seconds")
    plan = search.sample_plan(speeds, F.col("rows"), F.col("seconds") * 12, 14)
    return rounded(plan.select("model", "rows", "fit_rows_s", "sample_rows"))


# ---------------------------------------------------------------- models


def _facts(scored: DataFrame, regression: bool = True) -> DataFrame:
    """What must hold of predictions whose values no SQL can give: per row finite and, for labels or
    probabilities, within 0 to 1; for numbers, half the squared error of the mean or less over all rows."""
    if not regression:
        return scored.select("line_id", F.col("prediction").between(0.0, 1.0).alias("in_range"))
    scored = settle(scored.select("line_id", "target", "prediction"), "scored")
    gap = F.col("target") - F.col("prediction")
    better = scored.agg(F.avg(gap * gap) <= F.var_pop("target") / 2).first()[0]
    return scored.select("line_id", (F.abs("prediction") < float("inf")).alias("is_finite"), F.lit(better).alias("beats_mean"))


def _frequency_split(spark, folder):
    """Prepared (train, test) tables of the orders with their feature names."""
    train, test = split.split_hash(settle(orders(spark, folder), "orders"))
    prepared = pipeline.prepare(train, pipeline.FREQUENCY)
    return prepared.transform(train), prepared.transform(test), prepared.used


def _event_split(spark, folder):
    train, test = split.split_hash(events(spark, folder))
    prepared = pipeline.prepare(train, pipeline.ONEHOT)
    return prepared.transform(train), prepared.transform(test), prepared.used


@query
def fit_ridge(spark, folder):
    df = _one_feature(spark, folder)
    fitted = models.fit(models.ridge(models.Shape.of(df, ["number_1"])), df, ["number_1"])
    row = (float(fitted.model.coefficients[0]), float(fitted.model.intercept))
    return rounded(spark.createDataFrame([row], "coefficient double, intercept double"))


@query
def fit_logistic(spark, folder):
    train, test, names = _event_split(spark, folder)
    fitted = models.fit(models.logistic(models.Shape.of(train, names)), train, names)
    # The intercept carries no penalty, so at the optimum the mean probability is the share of the class.
    scored = fitted.predict(train, True)
    gap = scored.agg(F.abs(F.avg("prediction") - F.avg("target"))).first()[0]
    found = response.importances(fitted, spark)
    return found.agg((F.count(F.lit(1)) == len(names)).alias("every_feature"), (F.lit(gap) < 1e-4).alias("balanced"))


@query
def fit_gbt_reg(spark, folder):
    train, test, names = _frequency_split(spark, folder)
    return _facts(models.fit(models.boosted(models.REGRESSION), train, names).predict(test))


@query
def fit_gbt_cls(spark, folder):
    train, test, names = _event_split(spark, folder)
    return _facts(models.fit(models.boosted(models.CLASSIFICATION, ROUNDS), train, names).predict(test), False)


@query
def fit_forest(spark, folder):
    train, test, names = _frequency_split(spark, folder)
    return _facts(models.fit(models.forest(models.REGRESSION), train, names).predict(test))


@query
def fit_linear_svm(spark, folder):
    train, test, names = _event_split(spark, folder)
    return _facts(models.fit(models.linear_svm(models.Shape.of(train, names)), train, names).predict(test), False)


@query
def fit_document_quality(spark, folder):
    df = tables.labelled_documents(spark, folder)
    scorer = pipeline.train(df, models.CLASSIFICATION, models.logistic, pipeline.ONEHOT)
    return _facts(scorer.predict(df, probability=True), False)


def _board_facts(board: DataFrame) -> DataFrame:
    """(model, scored, timed) of a leaderboard."""
    return board.select("model", F.col("score").isNotNull().alias("scored"), ((F.col("fit_rows_s") > 0) & (F.col("predict_rows_s") > 0)).alias("timed"))


@query
def candidate_leaderboard(spark, folder):
    train, _, names = _frequency_split(spark, folder)
    return _board_facts(search.leaderboard(models.boosted_pair(models.REGRESSION, ROUNDS // 2), train, names, models.REGRESSION))


def _single_column_board(spark, folder):
    """Leaderboard of one-column least-squares fits on all rows, from sums alone."""
    df = nulls.fill_constant(expanded(spark, folder))
    names = [*ORDER_NUMBERS, "number_const", *DATE_NUMBERS]
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("model"),
            (-(F.var_pop("target") - F.try_divide(F.pow(F.covar_pop(n, "target"), 2), F.var_pop(n)))).alias("score"),
            F.count(n).alias("fit_rows_s"),
            F.countDistinct(n).alias("predict_rows_s") if n == "number_1" else F.count(n).alias("predict_rows_s"),
        )
        for n in names
    ])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


@query
def select_above_mean(spark, folder):
    board = _single_column_board(spark, folder)
    best = search.winner(board).first()["model"]
    kept = search.survivors(board).withColumn("is_winner", F.col("model") == F.lit(best))
    return rounded(kept, 4).select("model", "score", "is_winner")


def _depth_trials(spark, folder):
    """Score of the group means over key modulo depth, for each depth."""
    df = orders(spark, folder).select(F.col("id_0").cast("bigint").alias("customer"), "target")
    tried = df.select("target", "customer", F.explode(F.lit(search.DEPTHS)).alias("depth"))
    groups = tried.groupBy("depth", (F.col("customer") % F.col("depth")).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("target").alias("s"), F.sum(F.col("target") * F.col("target")).alias("ss")
    )
    unexplained = F.sum(F.col("ss") - F.col("s") * F.col("s") / F.col("n"))
    return groups.groupBy("depth").agg(F.round(-unexplained / F.sum("n"), 4).alias("score"))


@query
def first_best_rule(spark, folder):
    return search.first_best(_depth_trials(spark, folder))


@query
def depth_search(spark, folder):
    train, _, names = _frequency_split(spark, folder)
    estimator = models.boosted(models.REGRESSION, 3)
    best, tried = search.depth_search(estimator, train, names, models.REGRESSION)
    rows = [tuple(r) for r in tried.orderBy("depth").collect()]
    # No score before the last is worse than the one before it, and the kept depth is the last that was not worse.
    steady = all(a[1] <= b[1] for a, b in zip(rows, rows[1:-1], strict=False))
    dropped = len(rows) > 1 and rows[-1][1] < rows[-2][1]
    kept = rows[-2][0] if dropped else rows[-1][0]
    first = [r[0] for r in rows] == search.DEPTHS[: len(rows)]
    ended = dropped or len(rows) == len(search.DEPTHS)
    return spark.createDataFrame(
        [(first, steady, ended, best.getMaxDepth() == kept)], "in_order boolean, steady boolean, ended boolean, kept_rule boolean"
    )


@query
def grid_search(spark, folder):
    train, _, names = _frequency_split(spark, folder)
    estimator = models.boosted(models.REGRESSION, 3)
    return search.grid_search(estimator, {"maxDepth": [2, 4], "stepSize": [0.1, 0.3]}, train, names, models.REGRESSION)[1].select(
        "params", (F.col("score") < 0).alias("scored")
    )


@query
def ridge_grid(spark, folder):
    """Every penalty and fold of a ridge regression on one column, from one pass of sums."""
    table = ridge.ridge_grid(_one_feature(spark, folder), ["number_1"])[1]
    return rounded(table.select("alpha", "fold", "rows", "mse", F.col("weights")[0].alias("weight"), "intercept"))


@query
def ridge_grid_wide(spark, folder):
    """The same on 64 columns: predictions of the best penalty against the mean, per held-out row."""
    train, test = split.split_hash(tables.embedding_features(spark, folder))
    names = project.by_prefix(train.columns)
    best, table = ridge.ridge_grid(train, names)
    score = table.groupBy("alpha").agg(F.avg("mse").alias("score"))
    found = score.orderBy("score", F.desc("alpha")).first()["alpha"] == best.alpha
    return best.predict(test).select("line_id", (F.abs("prediction") < float("inf")).alias("is_finite"), F.lit(found).alias("best_alpha"))


@query
def stacked_out_of_fold(spark, folder):
    """Every training row, scored by models that did not see its fold, and whether the stack beats or equals each family."""
    train, test, names = _frequency_split(spark, folder)
    families = {"linear": models.ridge(models.Shape.of(train, names)), "forest": models.forest(models.REGRESSION)}
    stacked = stack.fit_stacked(families, train, names, models.REGRESSION)
    apart = score.rmse(stacked.predict(test)).first()[0]
    each = {n: score.rmse(f.predict(test)).first()[0] for n, f in stacked.base.items()}
    table = stacked.table
    finite = " and ".join(f"abs({stack.column(n)}) < double('inf')" for n in families)
    return table.select("line_id", "fold", F.expr(finite).alias("is_finite"), F.lit(apart <= min(each.values()) * 1.01).alias("no_worse"))


@query
def predict_label(spark, folder):
    train, test = split.split_hash(_one_feature(spark, folder))
    return rounded(_ridge_scorer(train).predict(test).select("line_id", "prediction"), 5)


@query
def predict_proba(spark, folder):
    train, test = split.split_hash(events(spark, folder))
    scorer = pipeline.train(train, models.CLASSIFICATION, models.logistic, pipeline.ONEHOT)
    return _facts(scorer.predict(test, probability=True), False)


@query
def automl_leaderboard(spark, folder):
    train, _, names = _event_split(spark, folder)
    candidates = models.all_families(models.CLASSIFICATION, models.Shape.of(train, names))
    return _board_facts(search.leaderboard(candidates, train, names, models.CLASSIFICATION))


def _curve_facts(curve: DataFrame) -> DataFrame:
    """Rounds, and whether boosting brought the error down from the first to the last."""
    last = F.max(F.struct("iter", "rmse"))["rmse"]
    first = F.min(F.struct("iter", "rmse"))["rmse"]
    return curve.agg(F.count(F.lit(1)).alias("rounds"), (last < first).alias("comes_down"), (F.min("rmse") > 0).alias("positive"))


@query
def boost_curve(spark, folder):
    train, test, names = _frequency_split(spark, folder)
    curve = response.boost_curve(models.fit(models.boosted(models.REGRESSION, ROUNDS), train, names), test)
    return _curve_facts(curve)


@query
def feature_response(spark, folder):
    train, test, names = _frequency_split(spark, folder)
    found = response.feature_table(models.fit(models.boosted(models.REGRESSION, ROUNDS), train, names), test)
    # Mean sizes bound mean changes, and all importances share one.
    bounded = F.bool_and((F.abs("fr_dec") <= F.col("frd_abs") + 1e-9) & (F.abs("fr_inc") <= F.col("fri_abs") + 1e-9))
    share = F.abs(F.sum("importance") - 1) < 1e-9
    return found.agg(share.alias("shares_one"), F.coalesce(bounded, F.lit(False)).alias("bounded"))


@query
def feature_response_linear(spark, folder):
    df = _one_feature(spark, folder)
    fitted = models.fit(models.ridge(models.Shape.of(df, ["number_1"])), df, ["number_1"])
    return rounded(response.responses(fitted, df, ["number_1"]), 5)


# ---------------------------------------------------------------- scores


def _aligned(spark, folder):
    df = tables.with_prediction(orders(spark, folder))
    truth, prediction = df.select("line_id", "target"), df.select("line_id", "prediction")
    return truth, prediction


@query
def score_rmse(spark, folder):
    return rounded(score.rmse(score.align(*_aligned(spark, folder))))


@query
def score_neg_mse(spark, folder):
    return rounded(score.neg_mse(score.align(*_aligned(spark, folder))))


@query
def score_rmse_two_col(spark, folder):
    return rounded(score.rmse_two_columns(*_aligned(spark, folder)))


@query
def align_prediction(spark, folder):
    return score.align(*_aligned(spark, folder))


@query
def score_auc(spark, folder):
    return rounded(score.auc(events(spark, folder), score="number_0"), 9)


@query
def score_auc_distributed(spark, folder):
    """The same area by range-partitioned running sums, as taken for very many distinct scores."""
    return rounded(score.auc(events(spark, folder), score="number_0", one_window=0), 9)


@query
def score_auc_labels(spark, folder):
    df = events(spark, folder).withColumn("prediction", (F.col("number_0") > 10).cast("int"))
    return rounded(score.auc_of_labels(df), 9)


@query
def run_metrics(spark, folder):
    prepared = pipeline.prepare(orders(spark, folder), pipeline.FILL_FIRST)
    found = pipeline.run_metrics(spark, prepared, dataset="orders_features")
    steps = [c for c in found.columns if c.startswith("seconds_")]
    timed = F.lit(all(prepared.seconds[c.removeprefix("seconds_")] > 0 for c in steps))
    return found.drop(*steps).withColumns({"steps": F.lit(len(steps)), "timed": timed})


# ---------------------------------------------------------------- whole plans


@query
def prep_slice(spark, folder):
    filled = nulls.fill_constant(expanded(spark, folder).drop("target"))
    table, _ = profile.drop_constant(filled)
    return project.pick(table, project.by_prefix(table.columns), ["line_id"])


@query
def prep_onehot(spark, folder):
    df = settle(orders(spark, folder), "orders")
    return rounded(pipeline.prepare(df, pipeline.ONEHOT).transform(df))


@query
def prep_onehot_nan(spark, folder):
    """NaN is a missing value like null: the same preparation from a table that has one for the other."""
    df = orders(spark, folder)
    holes = df.withColumns({n: F.coalesce(F.col(n), F.lit(float("nan"))) for n in ("number_0", "number_null")})
    holes = settle(holes, "holes")
    return rounded(pipeline.prepare(holes, pipeline.ONEHOT).transform(holes))


@query
def prep_fill_first(spark, folder):
    df = settle(orders(spark, folder), "orders")
    return rounded(pipeline.prepare(df, pipeline.FILL_FIRST).transform(df))


@query
def prep_budget(spark, folder):
    df = settle(orders(spark, folder), "orders")
    recipe = pipeline.replace(pipeline.BUDGET, most_columns=40)
    return pipeline.prepare(df, recipe).transform(df)


@query
def prep_freq(spark, folder):
    df = settle(orders(spark, folder), "orders")
    return pipeline.prepare(df, pipeline.FREQUENCY).transform(df)


@query
def replay_freq(spark, folder):
    train, test = split.split_hash(orders(spark, folder))
    return pipeline.prepare(train, pipeline.FREQUENCY).transform(test.drop("target"))


@query
def train_onehot(spark, folder):
    train, test = split.split_hash(orders(spark, folder))
    scorer = pipeline.train(train, models.REGRESSION, models.ridge, pipeline.ONEHOT)
    return _facts(scorer.predict(test))


@query
def train_freq(spark, folder):
    train, test = split.split_hash(orders(spark, folder))
    scorer, _ = pipeline.train_best(
        train, models.REGRESSION, models.boosted_pair(models.REGRESSION, ROUNDS), pipeline.FREQUENCY, depths=search.DEPTHS[:4]
    )
    return _facts(scorer.predict(test))


@query(name="score_pipeline")
def score_pipeline_query(spark, folder):
    """Read a CSV folder, replay the fitted state on it, and write the predictions: the whole of scoring."""
    train, test = split.split_hash(_one_feature(spark, folder))
    path, out = scratch_path(spark, "score-csv"), scratch_path(spark, "score-out")
    test.drop("target").write.option("header", True).csv(path)
    sinks.save_predictions(_ridge_scorer(train).predict(scan.scan_csv(spark, path)), out)
    return rounded(spark.read.schema("line_id bigint, prediction double").option("header", True).csv(out), 5)


@query
def select_by_samples(spark, folder):
    """Selection on growing samples: the family that can only predict the mean drops out before the round on all rows."""
    train, _, names = _frequency_split(spark, folder)
    shape = models.Shape.of(train, names)
    families = {"linear": models.ridge(shape), "forest": models.forest(models.REGRESSION), "mean": models.ridge(shape, 1e15)}
    name, board = search.select_model(families, train, names, models.REGRESSION, samples=(1_000, 4_000))
    left = {r["model"]: r["score"] for r in board.collect()}
    facts = (name in left, left.get(name) == max(left.values()), "mean" not in left, name != "mean")
    return spark.createDataFrame([facts], "winner_on_board boolean, winner_is_best boolean, mean_is_out boolean, learned boolean")


@query
def score_replay(spark, folder):
    train, test = split.split_hash(events(spark, folder))
    scorer = pipeline.train(train, models.CLASSIFICATION, models.logistic, pipeline.FILL_FIRST)
    path = scratch_path(spark, "scored")
    sinks.save_predictions(scorer.predict(test.drop("target"), probability=True), path)
    return _facts(spark.read.schema("line_id bigint, prediction double").option("header", True).csv(path), False)


@query
def batch_runs(spark, folder):
    sets = {
        "orders": (models.REGRESSION, *split.split_hash(orders(spark, folder))),
        "events": (models.CLASSIFICATION, *split.split_hash(events(spark, folder))),
    }
    out = scratch_path(spark, "batch-predictions")
    runs = pipeline.run_all(spark, sets, models.linear, pipeline.FREQUENCY, out)
    path = scratch_path(spark, "batch-metrics")
    sinks.append_metrics(runs, path)
    back = spark.read.schema(runs.schema).option("header", True).csv(path)
    score_ok = F.when(F.col("mode") == models.REGRESSION, F.col("score") > 0).otherwise(F.col("score").between(0.3, 1.0))
    timed = (F.col("train_seconds") > 0) & (F.col("predict_seconds") > 0)
    written = None
    for name in sets:
        part = spark.read.schema("line_id bigint, prediction double").option("header", True).csv(f"{out}/{name}")
        facts = part.agg(F.lit(name).alias("dataset"), F.count("prediction").alias("written"), F.sum("line_id").alias("key_sum"))
        written = facts if written is None else written.unionByName(facts)
    return back.join(F.broadcast(written), "dataset").select(  # one row a set
        "dataset", "mode", "rows", "columns", "method", "predicted_rows", "written", "key_sum", score_ok.alias("score_ok"), timed.alias("timed"),
        (F.length("run_id") == 36).alias("named"), (F.col("train_bytes") > 0).alias("sized"),
        F.get_json_object("parameters", "$.maxIter").isNotNull().alias("with_parameters"),
    )
