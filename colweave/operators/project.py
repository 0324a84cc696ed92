"""Column choice, guards and simple projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from colweave.operators.percolumn import per_column
from colweave.schema import DEFAULT_ROLES, KEY, Roles, col, quoted


class EmptyInput(ValueError):
    """Too few rows, or no feature column left."""


def split_label(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> tuple[DataFrame, DataFrame]:
    """(features with key, label with key); both stay lazy views of the same table."""
    label = roles.label
    keyed = [KEY] if KEY in df.columns else []
    return df.drop(label), df.select(*keyed, label)


def by_prefix(names: Sequence[str], prefixes: Sequence[str] = ("number", "onehot")) -> list[str]:
    return [c for c in names if c.startswith(tuple(prefixes))]


def by_denial(names: Sequence[str], encoded: Sequence[str] = (), roles: Roles = DEFAULT_ROLES) -> list[str]:
    """All but key, label, dates and text, unless the text column has been encoded to numbers."""
    barred = ("key", "label", "datetime", "string", "id", "categorical", "ignore")
    return [c for c in names if c in encoded or roles.of(c) not in barred]


def pick(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``names`` in this order, after the ``keep`` columns; an absent column is an error."""
    return df.selectExpr(*[quoted(c) for c in keep], *[quoted(c) for c in names if c not in keep])


def pick_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist; the scan reads only these."""
    present = set(df.columns)
    return df.selectExpr(*[quoted(c) for c in wanted if c in present])


def by_dtype(df: DataFrame, *dtypes: str) -> list[str]:
    return [name for name, dtype in df.dtypes if dtype in dtypes]


def append_block(df: DataFrame, block: Mapping[str, Column]) -> DataFrame:
    """Add a block of derived columns in one projection; rows need no join to line up."""
    return df.withColumns(dict(block))


def guard_rows(df: DataFrame, least: int = 2) -> int:
    """Fail early when the table has fewer than ``least`` rows; reads no more than that many."""
    seen = df.limit(least).count()
    if seen < least:
        raise EmptyInput(f"train table has {seen} rows, at least {least} are needed")
    return seen


def guard_features(names: Sequence[str]) -> None:
    if not names:
        raise EmptyInput("no feature column left")


def type_counts(df: DataFrame) -> DataFrame:
    """Number of columns and of non-missing values per column type, one pass."""
    found, _ = per_column(df, df.columns, {"filled": "count({v})"})
    totals: dict[str, tuple[int, int]] = {}
    for name, dtype in df.dtypes:
        columns, values = totals.get(dtype, (0, 0))
        totals[dtype] = (columns + 1, values + (found[name]["filled"] or 0))
    rows = [(dtype, *totals[dtype]) for dtype in sorted(totals)]
    return df.sparkSession.createDataFrame(rows, "dtype string, n_columns bigint, n_values bigint")
