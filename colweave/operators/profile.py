"""Column profiles: the numbers every fit starts from.

One aggregation reads each column once. Distinct counts come from theta
sketches: while a sketch holds every hash (up to 4096) its estimate is the
exact count; it is merged map-side and has a fixed size, so no value is
shuffled. An estimate is trusted as exact below ``EXACT_DISTINCT``, six
standard errors under the point where a sketch starts to estimate. Columns above that bound are counted exactly by grouping
only where the exact number is the result asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.order import rank_cutoffs
from colweave.operators.percolumn import LONG_COLUMNS, SKETCH_COLUMNS, per_column
from colweave.schema import KEY, batches, col, literal, quoted

SKETCH_LG = 12
NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
EXACT_DISTINCT = 3600


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    dtype: str
    rows: int
    filled: int
    low: Any  # of a number; the smallest hash for other types
    high: Any
    distinct: int  # exact below EXACT_DISTINCT, else an estimate
    mean: float | None = None

    @property
    def has_missing(self) -> bool:
        return self.filled < self.rows

    @property
    def constant(self) -> bool:
        """Exactly one value among the filled rows; an all-missing column has none.

        For other types than numbers the hashes of all values are equal, which
        two different values are in one of 2^64 cases.
        """
        return self.filled > 0 and self.low == self.high

    @property
    def values(self) -> int:
        """Distinct values with missing counted as one."""
        return self.distinct + int(self.has_missing)

    @property
    def exact(self) -> bool:
        return self.distinct < EXACT_DISTINCT


def _aggregates(sketch: bool):
    def of(dtype: str) -> dict[str, str]:
        number = dtype in NUMBER_TYPES or dtype.startswith("decimal")
        # of other types only the equality of the two ends matters: hashes keep the aggregation in fixed-width buffers
        ends = "{v}" if number else "if({v} is null, null, xxhash64({v}))"
        out = {"rows": "count(1)", "filled": "count({v})", "low": f"min({ends})", "high": f"max({ends})"}
        if number:
            out["mean"] = "avg({v})"
        if sketch:
            if number:
                text = "cast({v} as double)" if dtype in ("float", "double") else "cast({v} as bigint)"
            else:
                text = "concat('=', cast({v} as string))"  # a sketch skips the empty text
            if dtype.startswith("decimal"):
                text = "concat('=', cast({v} as string))"
            out["distinct"] = f"theta_sketch_estimate(theta_sketch_agg({text}, {SKETCH_LG}))"
        return out

    return of


def profile(df: DataFrame, names: Sequence[str] | None = None, sketch: bool = True) -> dict[str, ColumnProfile]:
    """Profile of each column; a few numbers per column reach the driver."""
    return profile_and(df, names, sketch)[0]


def profile_and(
    df: DataFrame, names: Sequence[str] | None = None, sketch: bool = True, more: Mapping[str, str] | None = None
) -> tuple[dict[str, ColumnProfile], dict[str, Any]]:
    """Profiles, and the values of ``more`` aggregate expressions taken in the same pass."""
    names = list(df.columns if names is None else names)
    types = dict(df.dtypes)
    found, extra = per_column(
        df, names, _aggregates(sketch), more=more, per_pass=SKETCH_COLUMNS if sketch else LONG_COLUMNS
    )
    out = {
        n: ColumnProfile(
            n, types[n], v["rows"] or 0, v["filled"] or 0, v["low"], v["high"],
            int(v["distinct"] or 0) if sketch else -1, v.get("mean"),
        )
        for n, v in found.items()
    }
    return out, extra


def constant_columns(df: DataFrame, names: Sequence[str] | None = None) -> list[str]:
    """Columns with exactly one distinct filled value: min = max, no distinct shuffle."""
    return [n for n, p in profile(df, names, sketch=False).items() if p.constant]


def drop_constant(df: DataFrame, names: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """(table without constant columns, names dropped)."""
    dropped = constant_columns(df, names)
    return df.drop(*dropped), dropped


def long_by_type(df: DataFrame, names: Sequence[str]) -> list[DataFrame]:
    """(column, value) rows, one DataFrame per value type, so that no value needs a cast."""
    types = dict(df.dtypes)
    out = []
    for dtype in sorted({types[n] for n in names}):
        group = [n for n in names if types[n] == dtype]
        pairs = F.array(*[F.struct(F.lit(n).alias("column"), col(n).alias("value")) for n in group])
        out.append(df.select(F.inline(pairs)).where(F.col("value").isNotNull()))
    return out


def distinct_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(column, n_distinct), missing values not counted, exact.

    Small columns are answered by the sketch pass. The others are grouped by
    (column, value) first, so a value that fills a third of the table is
    reduced map-side and a column's values spread over all reducers.
    """
    names = list(df.columns if names is None else names)
    spark = df.sparkSession
    profiles = profile(df, names)
    small = [(n, p.distinct) for n, p in profiles.items() if p.exact]
    large = [n for n, p in profiles.items() if not p.exact]
    out = spark.createDataFrame(small, "column string, n_distinct bigint")
    for pairs in long_by_type(df, large) if large else []:
        values = pairs.groupBy("column", "value").agg(F.lit(1).alias("one"))
        out = out.unionByName(values.groupBy("column").agg(F.count("one").alias("n_distinct")))
    return out


def row_has_missing(names: Sequence[str]) -> str:
    """Condition: a named column is missing. Blocks of ORs, so that a wide table makes no deep tree."""
    if not names:
        return "false"
    tests = [" or ".join(f"{quoted(n)} is null" for n in batch) for batch in batches(list(names), 20)]
    return f"exists(array({', '.join(tests)}), v -> v)"


def any_missing(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row ``any_missing``: does the table hold a missing value."""
    names = list(df.columns if names is None else names)
    return df.selectExpr(f"coalesce(bool_or({row_has_missing(names)}), false) as any_missing")


def nonconstant_by_prefix(df: DataFrame, steps: Sequence[int], names: Sequence[str], key: str = KEY) -> DataFrame:
    """(step, n_nonconstant): columns that are not constant on the first ``step`` rows by key.

    A column stays constant up to the first key at which it differs from its first value, so all steps follow from
    two numbers a column, however many steps there are: one aggregate a column finds the first filled key and its
    value, another the first key that differs. Each is one pass over the table (sums are combined map-side). A column
    without a filled value in the prefix does not count as constant. The cut key of each step comes from narrowing histograms.
    """
    k, names = quoted(key), list(names)
    cuts = rank_cutoffs(df, steps, key)
    filled = lambda n: f"if({quoted(n)} is null or {k} is null, null, struct({k} as k, {quoted(n)} as v))"
    found, _ = per_column(df, names, {"first": "min({v})"}, filled)
    first = {n: row["first"] for n, row in found.items() if row["first"] is not None}
    differs = lambda n: f"if({quoted(n)} <> {literal(first[n]['v'])}, {k}, null)"
    later, _ = per_column(df, list(first), {"key": "min({v})"}, differs)

    def constant(n: str, cut: int | None) -> bool:
        turn = later[n]["key"] if n in first else None
        return cut is not None and n in first and first[n]["k"] <= cut and (turn is None or turn > cut)

    counts = [(s, sum(not constant(n, cuts[s]) for n in names)) for s in steps]
    return df.sparkSession.createDataFrame(counts, "step bigint, n_nonconstant bigint")


def column_means(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, mean) of the numeric columns, one pass."""
    found, _ = per_column(df, names, {"mean": "avg({v})"})
    return df.sparkSession.createDataFrame([(n, v["mean"]) for n, v in found.items()], "column string, mean double")


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """(value, n), most frequent first, ties by value; missing values not counted."""
    counts = df.where(col(name).isNotNull()).groupBy(col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name).alias("value")).distinct()
