"""Missing values: constant, mean, mode and maximum fills, and the fitted policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colweave.operators.percolumn import per_column
from colweave.operators.profile import any_missing, long_by_type
from colweave.schema import is_number, literal, quoted

FILL_NUMBER = -1
FILL_TEXT = "-1"


def fill_constant(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Every missing value becomes -1; text columns get the text '-1'. One projection."""
    chosen = set(df.columns if names is None else names)
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if f.name in chosen and is_number(f.dataType):
            c = f"coalesce({c}, cast({FILL_NUMBER} as {f.dataType.simpleString()})) as {c}"
        elif f.name in chosen and isinstance(f.dataType, T.StringType):
            c = f"coalesce({c}, '{FILL_TEXT}') as {c}"
        out.append(c)
    return df.selectExpr(*out)


def fill_values(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Fill each named column with its own value; columns whose value is null stay as they are."""
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if values.get(f.name) is not None:
            c = f"coalesce({c}, cast({literal(values[f.name])} as {f.dataType.simpleString()})) as {c}"
        out.append(c)
    return df.selectExpr(*out)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_number(f.dataType)]


def _one_each(df: DataFrame, names: Sequence[str], function: str) -> dict[str, Any]:
    return {n: v["v"] for n, v in per_column(df, names, {"v": function + "({v})"})[0].items()}


def means(df: DataFrame, names: Sequence[str] | None = None) -> dict[str, Any]:
    return _one_each(df, numeric_columns(df) if names is None else names, "avg")


def maxima(df: DataFrame, names: Sequence[str] | None = None) -> dict[str, Any]:
    return _one_each(df, numeric_columns(df) if names is None else names, "max")


def modes(df: DataFrame, names: Sequence[str] | None = None) -> dict[str, Any]:
    """Most frequent value per column, the smallest one among equals.

    Two grouped steps: counts per (column, value) are combined map-side, then
    one smallest struct per column. No value set is held in one task.
    """
    names = list(df.columns if names is None else names)
    out: dict[str, Any] = {n: None for n in names}
    for pairs in long_by_type(df, names) if names else []:
        counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("best"))
        out.update({r["column"]: r["best"]["value"] for r in best.collect()})
    return out


@dataclass(frozen=True)
class FillPolicy:
    """What scoring does with missing values, decided at fit time.

    If the training table had missing values, scoring fills with -1. If it had
    none, scoring fills numbers with means: those of the training table, or of
    the scored table itself with ``stats='self'``.
    """

    missing: bool
    train_means: Mapping[str, Any]
    stats: str = "train"

    @classmethod
    def fit(cls, df: DataFrame, stats: str = "train") -> FillPolicy:
        missing = bool(any_missing(df).first()["any_missing"])
        return cls(missing, {} if missing or stats == "self" else means(df), stats)

    def __post_init__(self) -> None:
        if self.stats not in ("train", "self"):
            raise ValueError("stats must be 'train' or 'self'")

    def apply(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """Fill the named columns (all by default); reads the table only for ``stats='self'``."""
        if self.missing:
            return fill_constant(df, names)
        chosen = [n for n in numeric_columns(df) if names is None or n in names]
        found = self.train_means if self.stats == "train" else means(df, chosen)
        return fill_values(df, {n: found.get(n) for n in chosen})
