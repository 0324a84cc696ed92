"""Date text parsing and date parts, as column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave.schema import DEFAULT_ROLES, Roles, col

# Accepted text lengths with their patterns, and the date that stands for "none".
DATE_SHAPES = (r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
DATE_LENGTHS = (10, 19)
EMPTY_DATE = "0001-01-01 00:00:00"


def parse_date(c: Column, strict: bool = False) -> Column:
    """Text to a time without a zone, whatever the session's zone: 10 characters are a date, 19 a date with time, else null.

    Text of the right length that is no date gives null, or fails the job when
    ``strict`` is set.
    """
    shaped = c.rlike(DATE_SHAPES[0]) | c.rlike(DATE_SHAPES[1])
    found = F.when(shaped, c.try_cast("timestamp_ntz"))
    if not strict:
        return found
    wrong = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("timestamp_ntz")
    return F.when(F.length(c).isin(*DATE_LENGTHS), F.coalesce(found, wrong))


def parse_date_or_empty(c: Column, strict: bool = False) -> Column:
    """Same, with 0001-01-01 in place of null."""
    return F.coalesce(parse_date(c, strict), F.lit(EMPTY_DATE).cast("timestamp_ntz"))


def weekday(c: Column) -> Column:
    """Monday is 0."""
    return F.weekday(c)


def hour_of_week(c: Column) -> Column:
    return F.hour(c) + F.weekday(c) * 24


def minute_of_day(c: Column) -> Column:
    return F.minute(c) + F.hour(c) * 60


PARTS = {
    "year": F.year,
    "weekday": weekday,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "hour_of_week": hour_of_week,
    "minute_of_day": minute_of_day,
}

# The parts of the two expansions; the second one reads "no date" as 0001-01-01.
SIX_PARTS = ["weekday", "month", "day", "hour", "hour_of_week", "minute_of_day"]
FIVE_PARTS = ["year", "weekday", "month", "day", "hour"]


def part_name(part: str, column: str) -> str:
    return f"number_{part}_{column}"


def expand_dates(
    df: DataFrame,
    parts: list[str],
    empty_date: bool = False,
    strict: bool = False,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Parse every datetime column in place and add its parts.

    Two projections whatever the number of columns: one parses, one derives.
    """
    names = roles.columns(df.columns, "datetime")
    if not names:
        return df
    parse = parse_date_or_empty if empty_date else parse_date
    parsed = df.withColumns({n: parse(col(n), strict) for n in names})
    return parsed.withColumns({part_name(p, n): PARTS[p](col(n)) for n in names for p in parts})


def expand_six(df: DataFrame, roles: Roles = DEFAULT_ROLES, strict: bool = False) -> DataFrame:
    return expand_dates(df, SIX_PARTS, False, strict, roles)


def expand_five(df: DataFrame, roles: Roles = DEFAULT_ROLES, strict: bool = False) -> DataFrame:
    return expand_dates(df, FIVE_PARTS, True, strict, roles)
