"""Mutual information from nearest neighbours, on ranks.

Mutual information does not change if a column is replaced by its ranks. On ranks without ties the number of rows
within a distance along one column is known, so only the distance of the k-th neighbour in the plane is searched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave.operators.order import dense_codes
from colweave.schema import KEY, LABEL, col
from colweave.session import discard, settle

NEIGHBOURS = 3
LEAST_STRIP = 1 << 14


def _digamma(n: Column) -> Column:
    """The digamma function of an integer from 1, by its series at n + 6; errors stay under 1e-9."""
    m = n + 6.0
    series = F.log(m) - 1 / (2 * m) - 1 / (12 * m * m) + 1 / (120 * m * m * m * m) - 1 / (252 * m * m * m * m * m * m)
    for j in range(6):
        series = series - 1 / (n + float(j))
    return series


def _finite(name: str) -> Column:
    value = col(name).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def rank_pairs(df: DataFrame, names: Sequence[str], label: str, key: str) -> DataFrame:
    """(c, row_key, x, y): ranks from 0 of column c and of the label among the rows that have both.

    Ties go by the md5 of the key, another one on either side, which is as good as adding a little noise to both.
    """
    # The range sort reads its source twice.
    df = settle(df.select(*[col(n) for n in dict.fromkeys([*names, label, key])]), "pairs")
    k = col(key).cast("bigint")
    sides = []
    for i, n in enumerate(names):
        for side, value in (("x", _finite(n)), ("y", _finite(label))):
            both = _finite(n).isNotNull() & _finite(label).isNotNull() & k.isNotNull()
            # -0.0 and 0.0 are one value.
            place = F.struct((value + 0.0).alias("v"), F.unhex(F.md5(F.concat(k.cast("string"), F.lit(side)))).alias("tie"), k.alias("row_key"))
            sides.append(F.struct(F.lit(f"{side}{i}").alias("side"), F.when(both, place).alias("place")))
    long = df.select(F.inline(F.array(*sides))).where(F.col("place").isNotNull())
    coded = dense_codes(long, "side", "place").select(
        F.substring("side", 2, 9).cast("int").alias("c"), F.substring("side", 1, 1).alias("axis"), F.col("place.row_key").alias("row_key"), "code"
    )
    discard(df)
    at = [F.max(F.when(F.col("axis") == axis, F.col("code"))).cast("bigint").alias(axis) for axis in ("x", "y")]
    return coded.groupBy("c", "row_key").agg(*at)


def _nearest(x: np.ndarray, y: np.ndarray, qx: np.ndarray, qy: np.ndarray, within: np.ndarray, k: int) -> np.ndarray:
    """(rows, k): ascending distances under ``within`` from every asked point (qx, qy) to its nearest of (x, y), the rest filled
    with ``within``. A point that is asked for is no neighbour of its own.

    In the order of y both ways, one step for all points at once, until a point's next one is too far along y alone.
    """
    order = np.argsort(y)
    x, y = x[order], y[order]
    best = np.repeat(within[:, None], k, axis=1)
    start = np.searchsorted(y, qy)
    going = [(1, np.arange(len(qx)), start), (-1, np.arange(len(qx)), start - 1)]
    while going:
        left = []
        for step, rows, at in going:
            inside = (at >= 0) & (at < len(y))
            rows, at = rows[inside], at[inside]
            along = np.abs(y[at] - qy[rows])
            open_ = along < best[rows, -1]
            rows, at, along = rows[open_], at[open_], along[open_]
            apart = np.maximum(along, np.abs(x[at] - qx[rows]))
            nearer = (apart < best[rows, -1]) & (x[at] != qx[rows])
            hit = rows[nearer]
            best[hit, -1] = apart[nearer]
            best[hit] = np.sort(best[hit], axis=1)
            if len(rows):
                left.append((step, rows, at + step))
        going = left
    return best


def neighbour_distances(points: DataFrame, k: int, strip: int | None = None) -> DataFrame:
    """(c, x, y, d): the largest-coordinate distance from every point to its k-th nearest one of the same c.

    Points are dealt into strips along x. Ranks have no ties, so a strip of ``strip`` ranks holds as many points at most, and
    a task searches one at a time. What is nearest in its own strip bounds the distance; only points whose bound reaches over
    the strip's border ask the strips that it reaches, once. The gaps along y of a strip's points add up to k times
    all ranks at most, so few bounds reach far: with strips of four times the root of k times the rows or wider (the default), a
    strip is asked by a few times the points it holds at most, wherever points are dense.
    """
    last, n = points.agg(F.greatest(F.max("x"), F.max("y")), F.count(F.lit(1))).first()
    last = last or 0
    width = strip or max(LEAST_STRIP, 4 * math.isqrt(k * min(n, last + 1)))
    far = np.iinfo(np.int64).max
    columns = ["c", "x", "y"]

    def numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
        return [table.column(name).to_numpy() for name in names]

    def lists(best: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1) * k, pa.int32()), pa.array(best.ravel()))

    def within(table: pa.Table) -> pa.Table:
        x, y = numbers(table, "x", "y")
        best = _nearest(x, y, x, y, np.full(len(x), far), k)
        return table.select(columns).append_column("ds", lists(best))

    def beyond(table: pa.Table) -> pa.Table:
        bound = table.column("bound")
        held, asked = table.filter(pc.is_null(bound)), table.filter(pc.is_valid(bound))
        best = _nearest(*numbers(held, "x", "y"), *numbers(asked, "x", "y", "bound"), k)
        return asked.select(columns).append_column("ds", lists(best))

    schema = "c int, x bigint, y bigint, ds array<bigint>"
    at = F.expr(f"x div {width}L")
    own = settle(points.select(*columns, at.alias("strip")).groupBy("c", "strip").applyInArrow(within, schema), "strips")
    bound = F.get("ds", F.lit(k - 1))
    # What is nearer than the bound is less than it away along x; an unknown bound reaches every rank.
    beside = {"low": F.greatest(F.lit(0), F.col("x") - (bound - 1)), "high": last - F.greatest(F.lit(0), last - F.col("x") - (bound - 1))}
    reach = own.withColumns(beside).withColumns({name: F.expr(f"{name} div {width}L") for name in beside})
    crossing = F.col("low") != F.col("high")
    asks = reach.where(crossing).select(*columns, bound.alias("bound"), F.explode(F.sequence("low", "high")).alias("strip")).where(F.col("strip") != at)
    held = points.select(*columns, F.lit(None).cast("bigint").alias("bound"), at.alias("strip"))
    others = held.unionByName(asks).groupBy("c", "strip").applyInArrow(beyond, schema)
    all_found = F.sort_array(F.flatten(F.collect_list("ds")))
    met = reach.where(crossing).select(*columns, "ds").unionByName(others).groupBy(*columns).agg(F.get(all_found, F.lit(k - 1)).alias("d"))
    whole = reach.where(~crossing).select(*columns, bound.alias("d")).unionByName(met)
    return whole.where(F.col("d") < far)


def neighbour_information(
    df: DataFrame, names: Sequence[str], label: str = LABEL, k: int = NEIGHBOURS, key: str = KEY
) -> DataFrame:
    """(column, mi) in nats between each column and the label, from the distance of the k-th neighbour.

    digamma(k) + digamma(rows) - mean of digamma(a + 1) + digamma(b + 1), where a and b count the other rows nearer
    than the k-th neighbour along either column; never under 0. Values of columns with few distinct ones are told apart by
    chance, which leaves their information as it is. Rows that lack either value (or are NaN, infinite, without
    key) are left out column by column; with k rows or fewer ``mi`` is null. Keys must be unique.
    """
    names = list(names)
    spark = df.sparkSession
    all_names = spark.createDataFrame(list(enumerate(names)), "c int, column string")
    if not names:
        return all_names.select("column", F.lit(None).cast("double").alias("mi"))
    points = settle(rank_pairs(df, names, label, key), "ranks")
    sizes = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"))  # one row a column
    found = neighbour_distances(points, k).join(F.broadcast(sizes), "c")

    def nearer(axis: str) -> Column:
        return F.least(F.col("n") - 1, F.col(axis) + F.col("d") - 1) - F.greatest(F.lit(0), F.col(axis) - F.col("d") + 1)

    mean = F.avg(_digamma(nearer("x") + 1.0) + _digamma(nearer("y") + 1.0))
    value = F.greatest(F.lit(0.0), _digamma(F.lit(float(k))) + _digamma(F.max("n").cast("double")) - mean)
    result = settle(found.groupBy("c").agg(value.alias("mi")), "information")
    discard(points)
    return all_names.join(F.broadcast(result), "c", "left").select("column", "mi")
