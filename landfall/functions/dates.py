"""Date conversions as built-in column expressions.

Every function maps a column to a column and yields NULL, never an error, for
a value that is no date. Results are text ``YYYY-MM-DD 00:00:00`` because the
warehouse stores its date columns as text; the ``*_date`` variants keep DATE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day 0 of the day-number calendar, and the open interval of day
# numbers whose date lies in years 1 to 9999.
DAY_ZERO = "1960-01-01"
DAY_RANGE = (-715510, 2936550)

# Fixed pattern: month, day, year with optional leading zeros or a blank in
# place of the day's zero, nothing before or after; the calendar has no year 0.
MDY_PATTERN = (
    r"^(1[0-2]|0[1-9]|[1-9])(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])(?!0000)(\d{4})\z"
)
_EIGHT_DIGITS = r"^\d{4}(?!0000)\d{4}\z"


def _midnight_text(date: Column) -> Column:
    return F.concat(date.cast("string"), F.lit(" 00:00:00"))


def day_number_to_date(days: Column) -> Column:
    """Days since 1960-01-01, fraction cut toward zero, to DATE."""
    low, high = DAY_RANGE
    # NaN sorts above every number, so the upper bound rejects it too.
    inside = (days > F.lit(low)) & (days < F.lit(high))
    return F.when(inside, F.date_add(F.lit(DAY_ZERO).cast("date"), days.cast("int")))


def day_number_to_text(days: Column) -> Column:
    return _midnight_text(day_number_to_date(days))


def mdy_to_date(text: Column) -> Column:
    """``MMDDYYYY`` text, read as leniently as C-style strptime does, to DATE.

    Eight plain digits, nearly every real value, take a branch of substrings;
    only the rest meet the capturing pattern. Eight digits leave exactly two
    each for month and day, so both branches accept the same dates.
    """
    dash = F.lit("-")
    plain = F.concat(
        F.substring(text, 5, 4),
        dash,
        F.substring(text, 1, 2),
        dash,
        F.substring(text, 3, 2),
    )
    lenient = F.concat(
        F.regexp_extract(text, MDY_PATTERN, 3),
        dash,
        F.regexp_extract(text, MDY_PATTERN, 1),
        dash,
        F.trim(F.regexp_extract(text, MDY_PATTERN, 2)),
    )
    iso = F.when(text.rlike(_EIGHT_DIGITS), plain).when(
        text.rlike(MDY_PATTERN), lenient
    )
    # Days no month has fail the cast.
    return iso.try_cast("date")


def mdy_to_text(text: Column) -> Column:
    return _midnight_text(mdy_to_date(text))


def month_tag(date: Column) -> Column:
    """Month tag such as ``sep19``."""
    return F.lower(F.date_format(date, "MMMyy"))
