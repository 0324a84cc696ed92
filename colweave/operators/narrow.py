"""Smaller column types, and what they save."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colweave.operators.percolumn import per_column
from colweave.schema import col

# Bytes per value and signed ranges of the integer types.
TYPE_WIDTHS = {
    "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "boolean": 1, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}
INTEGER_RANGES = {
    "tinyint": (-(2**7), 2**7 - 1),
    "smallint": (-(2**15), 2**15 - 1),
    "int": (-(2**31), 2**31 - 1),
    "bigint": (-(2**63), 2**63 - 1),
}
FLOAT_TOLERANCE = 5e-4
BIG_TABLE_BYTES = 500 * 1024 * 1024
DICTIONARY_CODE_BYTES = 4


def smallest_integer(low: int, high: int) -> str:
    return next(t for t, (a, z) in INTEGER_RANGES.items() if a <= low and high <= z)


@dataclass(frozen=True)
class Narrowing:
    """Target type per column; ``apply`` is one projection of casts."""

    types: dict[str, str]
    ends: dict[str, tuple[Any, Any]]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            col(c).cast(self.types[c]).alias(c) if c in self.types else col(c) for c in df.columns
        ])

    def table(self, df: DataFrame) -> DataFrame:
        """(column, from_type, to_type)"""
        old = dict(df.dtypes)
        rows = [(c, old[c], t) for c, t in self.types.items()]
        return df.sparkSession.createDataFrame(rows, "column string, from_type string, to_type string")


def fit_integers(df: DataFrame, names: Sequence[str] | None = None, unsigned: bool = False) -> Narrowing:
    """Smallest signed type that holds each integer column: one min/max aggregation.

    With ``unsigned`` only columns without a negative value are narrowed (Spark
    has signed types only). All-missing columns keep their type.
    """
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    names = whole if names is None else [n for n in names if n in whole]
    types: dict[str, str] = {}
    ends: dict[str, tuple[Any, Any]] = {}
    for n, v in per_column(df, names, {"low": "min({v})", "high": "max({v})"})[0].items():
        ends[n] = (v["low"], v["high"])
        if v["low"] is not None and not (unsigned and v["low"] < 0):
            types[n] = smallest_integer(v["low"], v["high"])
    return Narrowing(types, ends)


def fit_floats(df: DataFrame, names: Sequence[str] | None = None, tolerance: float = FLOAT_TOLERANCE) -> Narrowing:
    """Double columns whose every value survives single precision within ``tolerance``."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    names = wide if names is None else [n for n in names if n in wide]
    types: dict[str, str] = {}
    ends: dict[str, tuple[Any, Any]] = {}
    loss = {"loss": "max(abs({v} - cast(cast({v} as float) as double)))"}
    for n, v in per_column(df, names, loss)[0].items():
        ends[n] = (0.0, v["loss"])
        if v["loss"] is None or v["loss"] <= tolerance:
            types[n] = "float"
    return Narrowing(types, ends)


def table_bytes(df: DataFrame, dictionary: Sequence[str] = ()) -> DataFrame:
    """One row (rows, bytes): fixed widths x rows, plus the bytes of the text columns.

    Columns named in ``dictionary`` count as one code per row.
    """
    fixed = sum(TYPE_WIDTHS.get(t, 8) for n, t in df.dtypes if t != "string" and n not in dictionary)
    fixed += DICTIONARY_CODE_BYTES * len(dictionary)
    texts = [n for n, t in df.dtypes if t == "string" and n not in dictionary]
    total = F.count(F.lit(1)) * F.lit(fixed).cast("bigint")
    for n in texts:
        total = total + F.coalesce(F.sum(F.octet_length(col(n)).cast("bigint")), F.lit(0).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("rows"), total.alias("bytes"))


def size_report(before: DataFrame, after: DataFrame, dictionary: Sequence[str] = ()) -> DataFrame:
    """(old_bytes, new_bytes, ratio)"""
    zero = F.lit(0).cast("bigint")
    old = table_bytes(before).select(F.col("bytes").alias("old_bytes"), zero.alias("new_bytes"))
    new = table_bytes(after, dictionary).select(zero.alias("old_bytes"), F.col("bytes").alias("new_bytes"))
    both = old.unionByName(new).agg(F.sum("old_bytes").alias("old_bytes"), F.sum("new_bytes").alias("new_bytes"))
    return both.withColumn("ratio", F.round(F.try_divide("old_bytes", "new_bytes"), 2))


def big_table(df: DataFrame, limit: int = BIG_TABLE_BYTES) -> DataFrame:
    """One row (bytes, is_big)."""
    return table_bytes(df).select("bytes", (F.col("bytes") > F.lit(limit)).alias("is_big"))


def is_big(df: DataFrame, limit: int = BIG_TABLE_BYTES) -> bool:
    return bool(big_table(df, limit).first()["is_big"])
