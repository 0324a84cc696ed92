"""Prediction and metrics sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.operators.score import PREDICTION
from colweave.schema import KEY, col


def save_predictions(df: DataFrame, path: str, key: str = KEY) -> None:
    """Two columns, ``line_id,prediction``, replacing what is there."""
    df.select(col(key), col(PREDICTION)).write.mode("overwrite").option("header", True).csv(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append rows to a CSV folder; every part file carries the header once."""
    df.write.mode("append").option("header", True).csv(path)


def schema_hash(columns: Sequence[str]) -> str:
    return hashlib.md5("".join(columns).encode("utf-8")).hexdigest().upper()


def save_metrics(df: DataFrame, root: str, subfolder: str, run_id: str) -> str:
    """Append metrics to the folder of their own set of columns; gives that folder's hash.

    Rows with other columns go to another folder, so no file mixes headers.
    """
    named = df.withColumn("run_id", F.lit(run_id))
    digest = schema_hash(named.columns)
    named.write.mode("append").parquet(f"{root}/subfolder={subfolder}/schema_hash={digest}")
    return digest


def load_metrics(spark: SparkSession, root: str, subfolder: str) -> DataFrame | None:
    """All metrics of a subfolder joined by column name; None when there are none."""
    try:
        df = spark.read.option("mergeSchema", True).parquet(f"{root}/subfolder={subfolder}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df.drop("schema_hash")


def union_metrics(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a table lacks is null there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def export_metrics(df: DataFrame, path: str) -> None:
    """All metrics as one semicolon-separated CSV folder that a spreadsheet can open."""
    df.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
