"""Reading, settling and joining shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.session import scratch_path, settle

__all__ = ["bounded", "discard", "read", "salted_join", "settle", "settle_by", "settle_few", "unused"]

BROADCAST_ROWS = 2_000_000
# Rows of names and numbers that one task can take.
ONE_TASK_ROWS = 200_000
BUCKET_BYTES = 64 << 20
MOST_BUCKETS = 100_000  # Spark's own limit


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def bounded(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table of ids for broadcast if its counted rows are few; else it is joined by shuffle, with the same result."""
    return F.broadcast(ids) if ids.count() <= rows else ids


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settle_few(df: DataFrame, name: str, rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Settle a table of short rows. If its counted rows are few, it goes on as one file and partition: joins and groupings of
    such tables are one task instead of many exchanges. Beyond ``rows`` the same steps run by shuffle, with the same result."""
    written = settle(df, name)
    if written.count() > rows:
        return written
    one = settle(written.coalesce(1), name)
    discard(written)
    return one.coalesce(1)


def settle_by(df: DataFrame, key: str, size: Column, name: str) -> DataFrame:
    """Write ``df`` once in buckets by hash of ``key``: later joins on the key move the other side only.

    ``size`` is the bytes of a row; a bucket holds about 64 MB, and there are never fewer buckets than shuffle partitions.
    """
    spark = df.sparkSession
    total = df.agg(F.sum(size)).first()[0] or 0
    parts = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES)))
    path, table = scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    df.repartition(parts, key).write.bucketBy(parts, key).options(path=path, compression="zstd").saveAsTable(table)
    return spark.table(table)


def discard(*settled: DataFrame) -> None:
    """Delete settled tables that nothing reads any more; shared storage is freed at once."""
    for df in settled:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = hadoop(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def salted_join(
    many: DataFrame, few: DataFrame, on: list[str], spread_by: str | Column, rows: int = 20_000, counts: DataFrame | None = None
) -> DataFrame:
    """Inner join of ``many`` with the unique keys of ``few``; keys of over ``rows`` rows are split.

    Key counts are combined map-side first. A row of ``few`` is repeated once
    per ``rows`` rows that will meet it, so copies grow with ``many`` / ``rows``;
    a hot key's rows are dealt by ``spread_by`` over that many parts. Settled ``counts``
    (on, _n) of the rows of ``many`` save counting them.
    """
    known = counts is not None
    counts = (counts if known else many.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))).where(F.col("_n") > rows)
    parts = counts.withColumn("_parts", F.ceil(F.col("_n") / rows).cast("int")).drop("_n")
    parts = bounded(parts) if known else parts
    # Heavy keys are fewer than rows of ``many`` / ``rows``; the planner broadcasts or shuffles them by their size.
    left = many.join(parts, on, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_parts")), F.lit(0)).cast("int")
    ).drop("_parts")
    right = few.join(parts, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))
    ).drop("_parts")
    return left.join(right, [*on, "_salt"]).drop("_salt")
