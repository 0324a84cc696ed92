"""Feature tables over the benchmark's star schema and event log.

Missing values, constants and odd dates are derived by modulus, so that the
same rows come out of any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.functions.scalars import zero_pad
from colweave.session import spread


# Columns that together tell rows apart, for the tables that are worth spreading.
SPREAD_BY = {
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df, *SPREAD_BY[name]) if name in SPREAD_BY else df


def orders_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order; regression target.

    Line items are summed per order before the join (map-side combined), so a
    large order is one row by the time it is shuffled.
    """
    lines = read(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    # The projection keeps the join from taking over the dealing of a small input, whose parts could then not be merged.
    orders = read(spark, folder, "orders").withColumn("_seven", F.col("o_custkey") % 7)
    key, seven = F.col("o_orderkey"), F.col("_seven")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    clock = F.concat_ws(":", zero_pad(key % 24, 2), zero_pad(key % 60, 2), F.lit("00"))
    return orders.join(lines, key == F.col("l_orderkey"), "left").select(
        key.alias("line_id"),
        F.col("quantity").alias("number_0"),
        seven.cast("double").alias("number_1"),
        (seven.cast("double") * 2 + 1).alias("number_2"),
        F.when(key % 5 != 0, F.lit(1.0)).alias("number_const"),
        F.lit(None).cast("double").alias("number_null"),
        F.when(key % 13 != 0, F.col("o_orderpriority")).alias("string_0"),
        F.col("o_orderstatus").alias("string_1"),
        F.col("o_custkey").cast("string").alias("id_0"),
        F.when((key % 6).isin(0, 3), day)
        .when((key % 6).isin(1, 4), F.concat_ws(" ", day, clock))
        .when(key % 6 == 2, F.lit("n/a"))
        .alias("datetime_0"),
        (
            F.lit(3.0) * seven
            + F.lit(0.5) * F.coalesce("quantity", F.lit(-1.0))
            + ((key * 37) % 101).cast("double") / 10
        ).alias("target"),
    )


def events_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event; the label is 1 for a click."""
    return read(spark, folder, "events").select(
        F.col("event_id").alias("line_id"),
        F.col("value").alias("number_0"),
        F.get_json_object("props", "$.k").cast("double").alias("number_1"),
        F.col("user_id").cast("string").alias("id_0"),
        F.concat(F.lit("u"), (F.col("user_id") % 5).cast("string")).alias("string_0"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime_0"),
        (F.col("event_type") == "click").cast("int").alias("target"),
    )


def lineitem_features(spark: SparkSession, folder: str) -> DataFrame:
    """Line items under the column contract; they have no unique key."""
    return read(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("number_quantity"),
        F.col("l_extendedprice").alias("number_price"),
        F.col("l_discount").alias("number_discount"),
        F.col("l_tax").alias("number_tax"),
        F.col("l_linenumber").cast("double").alias("number_line"),
        F.col("l_returnflag").alias("string_flag"),
        F.col("l_linestatus").alias("string_status"),
        F.col("l_partkey").cast("string").alias("id_part"),
        F.col("l_suppkey").cast("string").alias("id_supplier"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("datetime_ship"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("target"),
    )


def embedding_features(spark: SparkSession, folder: str, width: int = 64) -> DataFrame:
    """One row per vector with its elements as number columns; the label is the vector's class."""
    return read(spark, folder, "embeddings").select(
        F.col("vec_id").alias("line_id"),
        *[F.col("embedding")[i].cast("double").alias(f"number_{i}") for i in range(width)],
        F.col("label").cast("double").alias("target"),
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that carry a quality label, with their length and traits as features."""
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("line_id"),
        F.col("n_chars").cast("double").alias("number_0"),
        F.col("lang").alias("string_0"),
        F.col("source").alias("string_1"),
        F.col("quality").cast("double").alias("target"),
    )


def wide_orders(spark: SparkSession, folder: str, width: int = 300) -> DataFrame:
    """``orders_features`` with many derived number columns."""
    extra = [f"cast((line_id * {2 * i + 3}L + {i}L) % {7 + i % 31}L as double) as number_w{i}" for i in range(width)]
    return orders_features(spark, folder).selectExpr("*", *extra)


def very_wide_orders(spark: SparkSession, folder: str, width: int = 3000) -> DataFrame:
    """Keys of the orders with ``width`` number columns, each third of them another one with noise of some size."""
    own = lambda i: f"(line_id * {2 * i + 3}L + {i}L) % {7 + i % 31}L"
    noise = lambda i: f"(line_id * {2 * i + 5}L) % 11L * {0.1 + i % 9 * 0.05!r}D"
    columns = [f"{own(i)} + {noise(i)}" if i % 3 == 2 and i > 2 else own(i) for i in range(width)]
    for i in range(5, width, 3):
        columns[i] = f"{'-' if i % 2 else ''}({own(i - 4)}) + {noise(i)}"
    keys = read(spark, folder, "orders").select(F.col("o_orderkey").alias("line_id"))
    return keys.selectExpr("line_id", *[f"cast({c} as double) as number_{i}" for i, c in enumerate(columns)])


def with_prediction(df: DataFrame) -> DataFrame:
    """(line_id, target, prediction) with the rounded target as prediction."""
    return df.select("line_id", "target", (F.round("target") + 0.0).alias("prediction"))
