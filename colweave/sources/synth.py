"""Derived test tables: reproducible numbers from keys, and injected missing values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.functions.scalars import HASH_MODULUS, ratio, row_hash
from colweave.schema import KEY, col


def noise_table(keys: DataFrame, columns: int, key: str = KEY) -> DataFrame:
    """One row per key with ``columns`` pseudo-random numbers in [0, 1), a dependent and a zero column.

    The numbers are arithmetic on the key, so they are the same on every run
    and layout. ``number_depend`` is (a + b) / (c * d) of the first four.
    """
    if columns < 4:
        raise ValueError("the dependent column needs 4 columns")
    drawn = {
        f"number_{i}": row_hash(col(key) * F.lit(2 * i + 3) + F.lit(i)) / F.lit(HASH_MODULUS) for i in range(columns)
    }
    a, b, c, d = (F.col(f"number_{i}") for i in range(4))
    base = keys.select(col(key)).withColumns(drawn)
    return base.withColumns({"number_depend": ratio(a + b, c * d), "number_zero": F.lit(0.0)})


def inject_missing(df: DataFrame, blocks: Mapping[str, tuple[int, int]], key: str = KEY) -> DataFrame:
    """Set ``column`` to null where start <= key < stop, for each named block."""
    hollow = {
        name: F.when(~((col(key) >= F.lit(start)) & (col(key) < F.lit(stop))), col(name))
        for name, (start, stop) in blocks.items()
    }
    return df.withColumns(hollow)
