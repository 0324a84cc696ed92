"""Ordered work without a one-partition window.

A window with no partition key pulls the whole table into one task. Positions
are reached here by two other ways: the cut key of a row rank is found by
narrowing histograms, and running sums are taken inside range partitions plus
an offset per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colweave.schema import KEY, col, quoted
from colweave.session import settle

HISTOGRAM_BINS = 4096
TOP_N = 10_000
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def rank_cutoffs(df: DataFrame, ranks: Sequence[int], key: str = KEY) -> dict[int, int | None]:
    """The key value at each 1-based rank of an integer key that is unique.

    Each pass counts rows in at most 4096 bins per rank (combined map-side, so
    the shuffle carries only bin counts) and narrows to the bin that holds the
    rank; the range filter reaches the scan. Three passes cover 10^12 rows of
    a dense key. A rank beyond the table gives the largest key, rank 0 or less
    gives None.
    """
    k = col(key).cast("bigint")
    ends = df.agg(F.min(k).alias("low"), F.max(k).alias("high"), F.count(k).alias("n")).first()
    out: dict[int, int | None] = {}
    open_ranks: dict[int, tuple[int, int, int]] = {}
    for rank in ranks:
        if rank <= 0 or ends["n"] == 0:
            out[rank] = None
        elif rank >= ends["n"]:
            out[rank] = ends["high"]
        else:
            open_ranks[rank] = (ends["low"], ends["high"], rank)
    while open_ranks:
        spans = sorted({(low, high) for low, high, _ in open_ranks.values()})
        widths = {s: -(-(s[1] - s[0] + 1) // HISTOGRAM_BINS) for s in spans}
        wanted: Column | None = None
        span_id = F.lit(None).cast("int")
        bin_id = F.lit(None).cast("bigint")
        for i, (low, high) in enumerate(spans):
            inside = k.between(low, high)
            wanted = inside if wanted is None else wanted | inside
            span_id = F.when(inside, F.lit(i)).otherwise(span_id)
            step = F.expr(f"(cast({quoted(key)} as bigint) - ({low})) div {widths[(low, high)]}")
            bin_id = F.when(inside, step).otherwise(bin_id)
        counted = df.where(wanted).groupBy(span_id.alias("span"), bin_id.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        bins: dict[int, list[tuple[int, int]]] = {}
        for r in counted.collect():
            bins.setdefault(r["span"], []).append((r["bin"], r["n"]))
        still: dict[int, tuple[int, int, int]] = {}
        for rank, (low, high, left) in open_ranks.items():
            width = widths[(low, high)]
            for b, n in sorted(bins[spans.index((low, high))]):
                if left <= n:
                    start = low + b * width
                    if width == 1:
                        out[rank] = start
                    else:
                        still[rank] = (start, min(start + width - 1, high), left)
                    break
                left -= n
        open_ranks = still
    return out


def row_prefix(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """The first ``n`` rows by key.

    A short prefix is a top-n (each task keeps n rows). A long one is a filter
    on the cut key, which reaches the scan and moves no row.
    """
    if n <= 0:
        return df.limit(0)
    if n <= TOP_N:
        return df.orderBy(col(key)).limit(n)
    cut = rank_cutoffs(df, [n], key)[n]
    return df.where(col(key) <= F.lit(cut))


def range_sorted(df: DataFrame, *order: str | Column) -> DataFrame:
    """Rows in global order with ``_part`` (range partition) and ``_pos`` (row within it).

    The layout is written once, so that both numbers mean the same in every
    later read. Range partitions are balanced by sampling; callers bring rows
    that are distinct in the sort key, so no key can swell one partition.
    """
    tag = F.monotonically_increasing_id()
    tagged = df.orderBy(*order).withColumn("_tag", tag)
    fixed = settle(tagged, "sorted")
    return fixed.withColumns({
        "_part": F.shiftright("_tag", ROW_BITS).cast("int"),
        "_pos": F.col("_tag").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
    }).drop("_tag")


def running_sums(df: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add exclusive running sums: ``sums`` maps new column to summed column.

    ``df`` must hold one row per sort key. Within a range partition a window
    adds up; the totals of the partitions before it come from a table with one
    row per partition, small enough to broadcast by construction.
    """
    laid = range_sorted(df, *order)
    totals = laid.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in sums])
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    joined = laid.join(F.broadcast(offsets), "_part")
    added = {new: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_o_{new}") for new, c in sums.items()}
    return joined.withColumns(added).drop("_part", "_pos", *[f"_o_{new}" for new in sums])


def dense_codes(df: DataFrame, group: str, value: str) -> DataFrame:
    """Add ``code``: 0-based rank of ``value`` within ``group``; rows must be distinct in both.

    Position = rows in earlier partitions + row within the partition, minus the
    first position of the group. Both helper tables are bounded by the number
    of partitions and of groups (columns).
    """
    laid = range_sorted(df, col(group), col(value))
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = laid.join(F.broadcast(offsets), "_part").withColumn("_at", F.col("_pos") + F.col("_offset"))
    firsts = placed.groupBy(group).agg(F.min("_at").alias("_first"))
    return (
        placed.join(F.broadcast(firsts), group)
        .withColumn("code", F.col("_at") - F.col("_first"))
        .drop("_part", "_pos", "_offset", "_at", "_first")
    )
