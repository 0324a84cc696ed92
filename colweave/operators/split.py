"""Splits by key, so that they do not depend on the row layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave.functions.scalars import HASH_MODULUS, row_hash
from colweave.operators.order import rank_cutoffs
from colweave.schema import KEY, col

TEST_SHARE = 0.25


# Salts of the row hash: the outer split, the split inside a search, the folds.
OUTER, INNER, FOLDS = 0, 1, 2


def in_test(key: str = KEY, share: float = TEST_SHARE, salt: int = OUTER) -> Column:
    return row_hash(col(key), salt) < F.lit(int(share * HASH_MODULUS))


def split_hash(
    df: DataFrame, share: float = TEST_SHARE, key: str = KEY, salt: int = OUTER
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash: two filters, no shuffle, the same rows on every run; rows without a key train."""
    test = F.coalesce(in_test(key, share, salt), F.lit(False))
    return df.where(~test), df.where(test)


def split_ordered(df: DataFrame, share: float = TEST_SHARE, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first rows by key train, and rows without a key. The cut key is found without a sort."""
    rows = df.where(col(key).isNotNull()).count()
    train_rows = int(rows * (1 - share))
    if train_rows <= 0:
        return df.where(col(key).isNull()), df.where(col(key).isNotNull())
    cut = rank_cutoffs(df, [train_rows], key)[train_rows]
    return df.where((col(key) <= F.lit(cut)) | col(key).isNull()), df.where(col(key) > F.lit(cut))


def with_fold(df: DataFrame, folds: int, key: str = KEY, name: str = "fold") -> DataFrame:
    """Add a fold number in [0, folds)."""
    if folds < 2:
        raise ValueError("at least 2 folds are needed")
    scaled = F.floor(row_hash(col(key), FOLDS) * F.lit(folds) / F.lit(HASH_MODULUS))
    return df.withColumn(name, scaled.cast("int"))
