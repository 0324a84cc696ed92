"""Small documents tables."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # Names that operators use themselves.
    T.StructField("size", T.StringType()), T.StructField("node", T.StringType()), T.StructField("doc", T.StringType()),
])


def frame(spark, rows):
    """Documents from (doc_id, text, lang), with more columns of clashing names."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def words(n, seed, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture()
def odd_rows():
    """Null, empty, blank, very long, repeated rows, null and repeated ids."""
    long = words(30_000, 1)
    return [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, long, "en"), (5, long, "de"), (6, "one", None),
        (6, "one", None), (None, "two words", "en"), (None, None, None), (7, "One", "en"), (8, words(200, 2), "fr"), (8, words(200, 3), "fr"),
    ]
