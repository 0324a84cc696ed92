"""Column roles: the name of a column says what it is.

``line_id`` is the row key and ``target`` the label; every other role follows
from a prefix. A role map can override the prefix for single columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "line_id"
LABEL = "target"

# Prefixes of the input contract and the type each is read as.
PREFIX_TYPES: dict[str, T.DataType] = {
    "number": T.DoubleType(),
    "onehot": T.IntegerType(),
    "datetime": T.StringType(),
    "string": T.StringType(),
    "id": T.StringType(),
}

# Texts that the usual CSV readers take for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def quoted(name: str) -> str:
    """Column name safe to pass to ``F.col`` (derived names hold ``=`` and ``.``)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def literal(value) -> str:
    """A fitted value as SQL text.

    Wide projections are written as SQL text: one expression per column, where
    building the same thing from Column objects costs several driver calls each.
    """
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        return f"cast('{value!r}' as double)" if value != value or abs(value) == float("inf") else f"{value!r}D"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


class Roles:
    """Role of each column by prefix, with overrides by name.

    ``Roles({"price": "output", "number_3": "categorical"})`` makes ``price``
    the label and sends ``number_3`` to the encoders.
    """

    def __init__(self, overrides: Mapping[str, str] | None = None):
        self.overrides = dict(overrides or {})
        allowed = {"output", "categorical", "number", "datetime", "string", "id", "ignore"}
        unknown = set(self.overrides.values()) - allowed
        if unknown:
            raise ValueError(f"unknown roles: {sorted(unknown)}")

    @property
    def label(self) -> str:
        named = [c for c, role in self.overrides.items() if role == "output"]
        if len(named) > 1:
            raise ValueError(f"more than one output column: {named}")
        return named[0] if named else LABEL

    def of(self, name: str) -> str:
        if name == KEY:
            return "key"
        if name == self.label:
            return "label"
        if name in self.overrides:
            return self.overrides[name]
        return next((p for p in PREFIX_TYPES if name.startswith(p)), "other")

    def columns(self, names: Iterable[str], *roles: str) -> list[str]:
        return [c for c in names if self.of(c) in roles]

    def features(self, names: Iterable[str]) -> list[str]:
        return [c for c in names if self.of(c) not in ("key", "label", "ignore")]


DEFAULT_ROLES = Roles()


def prefix_schema(header: Sequence[str], roles: Roles = DEFAULT_ROLES) -> T.StructType:
    """Read schema for a header, so that no inference pass over the data is needed."""
    fields = []
    for name in header:
        role = roles.of(name)
        if role == "key":
            dtype: T.DataType = T.LongType()
        elif role == "label":
            dtype = T.DoubleType()
        elif role == "categorical":
            dtype = T.StringType()
        else:
            dtype = PREFIX_TYPES.get(role, T.StringType())
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def one_missing(df: DataFrame) -> DataFrame:
    """Make null the only missing value: NaN in numbers and missing-value texts become null."""
    out = []
    for field in df.schema.fields:
        c = col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(field.dataType, T.StringType):
            c = F.when(~c.isin(MISSING_TEXTS), c)
        out.append(c.alias(field.name))
    return df.select(*out)


def plain_numbers(df: DataFrame) -> DataFrame:
    """Numbers as every step expects them: decimals as doubles, and null in place of NaN and the infinities."""
    changed = {}
    for field in df.schema.fields:
        c = col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            changed[field.name] = c.cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = F.when(F.abs(c) < F.lit(float("inf")), c)
    return df.withColumns(changed) if changed else df


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def batches(names: Sequence[str], size: int = 200) -> list[list[str]]:
    """Column batches for wide aggregations: one job per batch reads only its columns."""
    return [list(names[i : i + size]) for i in range(0, len(names), size)]
