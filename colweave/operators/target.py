"""Categories as means of the label that no row takes part in itself.

For training, a row gets the mean over the earlier rows of its value, in an order that the key's hash gives. For
scoring, a value gets its mean over all training rows. Both are drawn towards the mean of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colweave.functions.scalars import row_hash
from colweave.operators.encode import Lookup, encoded_columns
from colweave.operators.split import FOLDS
from colweave.schema import KEY, LABEL, col
from colweave.session import settle

# How many rows of the mean of the table count with the rows of a value.
PRIOR_ROWS = 1.0

_RUNNING = "part int, first boolean, row_key bigint, column string, seen double, total double, edges array<struct<column:string,value:string,n:double,total:double>>"


def _label(label: str) -> Column:
    """The label as a number; null where it is missing, NaN or infinite."""
    number = col(label).cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _long(df: DataFrame, names: Sequence[str], label: str, *keep: Column) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), col(n).cast("string").alias("value")) for n in names])
    return df.select(*keep, _label(label).alias("label"), F.inline(pairs))


def _running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exclusive running counts and sums per value of sorted rows, and one last row with the sums of the values at both ends.

    Only the sums of the value at hand are held, however many rows it has.
    """
    schema = pa.schema([
        ("part", pa.int32()), ("first", pa.bool_()), ("row_key", pa.int64()), ("column", pa.string()), ("seen", pa.float64()),
        ("total", pa.float64()),
        ("edges", pa.list_(pa.struct([("column", pa.string()), ("value", pa.string()), ("n", pa.float64()), ("total", pa.float64())]))),
    ])
    part, edges, at, n, total = TaskContext.get().partitionId(), [], None, 0.0, 0.0
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        column, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        has = np.isfinite(y)
        y = np.where(has, y, 0.0)
        new = np.ones(size, bool)
        new[1:] = (column[1:] != column[:-1]) | (value[1:] != value[:-1])
        new[0] = at != (column[0], value[0])
        starts, group = np.flatnonzero(new), np.cumsum(new)
        sums = []
        for carried, x in ((n, has.astype(float)), (total, y)):
            before = np.concatenate([[0.0], np.cumsum(x)])
            sums.append(before[:-1] - np.concatenate([[-carried], before[starts]])[group])
        in_first = np.zeros(size, bool)
        if not edges:
            # The value at the start of the part ends at the second start, if there is one.
            limit = starts[starts > 0] if at is None else starts
            stop = int(limit[0]) if len(limit) else size
            in_first[:stop] = True
            if stop < size or (at is not None and stop == 0):
                name = at if stop == 0 else (column[stop - 1], value[stop - 1])
                closed = (n, total) if stop == 0 else (sums[0][stop - 1] + has[stop - 1], sums[1][stop - 1] + y[stop - 1])
                edges.append({"column": name[0], "value": name[1], "n": float(closed[0]), "total": float(closed[1])})
        n, total, at = float(sums[0][-1] + has[-1]), float(sums[1][-1] + y[-1]), (column[-1], value[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, part, np.int32)), pa.array(in_first), batch.column(0), batch.column(2), pa.array(sums[0]),
             pa.array(sums[1]), pa.nulls(size, schema.field("edges").type)],
            schema=schema,
        )
    if at is not None:
        edges.append({"column": at[0], "value": at[1], "n": n, "total": total})
        yield pa.RecordBatch.from_pylist([{"part": part, "edges": edges}], schema=schema)


def _sorted_sums(df: DataFrame, names: Sequence[str], label: str, key: str) -> DataFrame:
    """(part, first, row_key, column, seen, total) of every row and column, and one row of ``edges`` per part.

    One range exchange on (column, value, order, key): since the order is part of the sort key, a value that
    holds much of the table is cut over as many parts as its rows need.
    """
    k = col(key).cast("bigint")
    long = _long(df.where(k.isNotNull()), names, label, k.alias("row_key"), row_hash(k, FOLDS).alias("turn"))
    laid = long.orderBy("column", F.col("value").asc_nulls_first(), "turn", "row_key").select("row_key", "label", "column", "value")
    return laid.mapInArrow(_running, _RUNNING)


def ordered_target_encode(
    df: DataFrame, names: Sequence[str] | None = None, label: str = LABEL, key: str = KEY, prior_rows: float = PRIOR_ROWS
) -> DataFrame:
    """Replace each column by the mean label of the earlier rows of the same value, for training.

    (sum of the earlier labels + prior_rows * mean label of the table) / (earlier rows + prior_rows), where earlier
    means a smaller hash of the key (then a smaller key). A row's own label is never in its running sums. Missing
    values are one value. Rows without a finite label are encoded but count for nothing. Keys must be unique; a row
    without a key gets the mean of the table. A table without labels gets nulls. Names default to id and text columns.

    The sums run inside range parts; a value that goes on over several parts takes the sums of the parts before
    it from a table of at most two rows per part.
    """
    names = encoded_columns(df.columns) if names is None else list(names)
    if not names:
        return df
    prior = df.agg(F.avg(_label(label))).first()[0]
    prior_value = F.lit(prior).cast("double")
    laid = settle(_sorted_sums(df, names, label, key), "target-order")
    ends = laid.where(F.col("edges").isNotNull()).select("part", F.posexplode("edges").alias("place", "edge"))
    before = Window.partitionBy("edge.column", "edge.value").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        "part", "place", F.sum("edge.n").over(before).alias("seen_before"), F.sum("edge.total").over(before).alias("total_before"),
    ).where((F.col("place") == 0) & F.col("seen_before").isNotNull()).drop("place")
    rows = laid.where(F.col("edges").isNull()).drop("edges").join(F.broadcast(offsets), "part", "left")  # one row a part
    seen = F.col("seen") + F.when(F.col("first"), F.coalesce("seen_before", F.lit(0.0))).otherwise(0.0)
    total = F.col("total") + F.when(F.col("first"), F.coalesce("total_before", F.lit(0.0))).otherwise(0.0)
    value = (total + prior_rows * prior_value) / (seen + prior_rows)
    encoded = rows.groupBy("row_key").agg(*[F.max(F.when(F.col("column") == F.lit(n), value)).alias(f"_t{i}") for i, n in enumerate(names)])
    joined = df.join(encoded, col(key).cast("bigint") == F.col("row_key"), "left")
    at = {n: F.coalesce(F.col(f"_t{i}"), prior_value).alias(n) for i, n in enumerate(names)}
    return joined.select(*[at.get(c, col(c)) for c in df.columns])


@dataclass(frozen=True)
class TargetMeans:
    """Value -> mean label of its training rows, drawn towards the mean of the table; applied by lookup."""

    lookup: Lookup
    prior: float
    low: float
    missing: Mapping[str, float]

    def apply(self, df: DataFrame, **limits: int) -> DataFrame:
        """Replace each fitted column; unseen values get the mean of the table. ``limits`` go to the lookup's join.

        A lookup gives -1 for what it does not know, so its codes are kept as distances from the smallest label.
        """
        known = [n for n in self.lookup.sizes if n in df.columns]
        out = self.lookup.apply(df.withColumns({f"_m{i}": col(n).isNull() for i, n in enumerate(known)}), **limits)
        at = {
            n: F.when(F.col(f"_m{i}"), F.lit(self.missing.get(n, self.prior)))
            .when(col(n) < 0, F.lit(self.prior)).otherwise(col(n) + F.lit(self.low)).alias(n)
            for i, n in enumerate(known)
        }
        return out.select(*[at.get(c, col(c)) for c in df.columns])


def fit_target_means(
    df: DataFrame, names: Sequence[str] | None = None, label: str = LABEL, prior_rows: float = PRIOR_ROWS
) -> TargetMeans:
    """(sum of the labels of a value + prior_rows * mean label) / (rows of the value + prior_rows), over all training rows.

    One map-side combined grouping for all columns. Missing values are one value. Without any finite label every mean is 0.
    """
    names = encoded_columns(df.columns) if names is None else list(names)
    ends = df.agg(F.avg(_label(label)).alias("prior"), F.min(_label(label)).alias("low")).first()
    prior, low = ends["prior"] or 0.0, ends["low"] or 0.0
    if not names:
        empty = df.sparkSession.createDataFrame([], "column string, value string, n bigint, code double")
        return TargetMeans(Lookup(empty, 0, {}), prior, low, {})
    mean = (F.coalesce(F.sum("label"), F.lit(0.0)) + F.lit(prior_rows * prior)) / (F.count("label") + F.lit(prior_rows))
    counted = settle(
        _long(df, names, label).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.greatest(mean - low, F.lit(0.0)).alias("code")),
        "target-means",
    )
    missing = {r["column"]: r["code"] + low for r in counted.where(F.col("value").isNull()).collect()}  # one row a column
    known = counted.where(F.col("value").isNotNull())
    return TargetMeans(Lookup.of(known, df.count(), names), prior, low, missing)
