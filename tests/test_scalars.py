import pytest
from pyspark.sql import functions as F

from colweave.functions import dates, scalars


def _parse(spark, text, parse=dates.parse_date, strict=False):
    df = spark.createDataFrame([(text,)], "d string")
    return df.select(F.date_format(parse(F.col("d"), strict), "yyyy-MM-dd HH:mm:ss")).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2010-01-01", "2010-01-01 00:00:00"),
        ("2010-01-01 10:10:10", "2010-01-01 10:10:10"),
        ("2010-1-1", None),
        ("2010-13-01", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_by_length(spark, text, want):
    assert _parse(spark, text) == want
    assert _parse(spark, text, dates.parse_date_or_empty) == (want or dates.EMPTY_DATE)


def test_strict_parse_fails(spark):
    assert _parse(spark, "2010-01-31", strict=True) == "2010-01-31 00:00:00"
    with pytest.raises(Exception, match="2010-13-01"):
        _parse(spark, "2010-13-01", strict=True)


def test_expansions(spark):
    df = spark.createDataFrame([(1, "2010-01-01 10:20:30"), (2, None)], "line_id int, datetime_0 string")
    six = dates.expand_six(df).orderBy("line_id").collect()
    names = [dates.part_name(p, "datetime_0") for p in dates.SIX_PARTS]
    assert [six[0][n] for n in names] == [4, 1, 1, 10, 10 + 4 * 24, 20 + 10 * 60]
    assert [six[1][n] for n in names] == [None] * 6
    five = dates.expand_five(df).orderBy("line_id").collect()
    names = [dates.part_name(p, "datetime_0") for p in dates.FIVE_PARTS]
    assert [five[0][n] for n in names] == [2010, 4, 1, 1, 10]
    assert [five[1][n] for n in names] == [1, 0, 1, 1, 0]


def test_expand_without_dates_is_the_same(spark):
    df = spark.range(1)
    assert dates.expand_six(df) is df


def test_rounding_and_ratio(spark):
    row = spark.sql("select 0.25D a, 0.35D b, 0.0D z").select(
        scalars.scale_and_round(F.col("a")), scalars.ratio(F.col("a"), F.col("z")), scalars.ratio(F.col("a"), F.col("z"), 0.5)
    ).first()
    assert tuple(row) == (2.0, None, 0.5)


def test_text_helpers(spark):
    row = spark.sql("select 'a' a, 7 n, 20183 m").select(
        scalars.md5_upper(F.col("a")), scalars.zero_pad(F.col("n")), scalars.zero_pad(F.col("m"))
    ).first()
    assert tuple(row) == ("0CC175B9C0F1B6A831C399E269772661", "0007", "20183")


def test_run_id_is_one_per_call(spark):
    ids = spark.range(5).select(scalars.run_id().alias("r")).distinct().count()
    assert ids == 1
