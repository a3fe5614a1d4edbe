"""Date conversions: hand-written cases and agreement with Python's datetime."""

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.functions import (
    day_number_to_date,
    day_number_to_text,
    mdy_to_date,
    mdy_to_text,
    month_tag,
)
from landfall.plans.month import tag_of

DAY_CASES = [
    (20573.0, "2016-04-29 00:00:00"),
    (20573.9, "2016-04-29 00:00:00"),
    (0.0, "1960-01-01 00:00:00"),
    (-0.5, "1960-01-01 00:00:00"),
    (-715509.9, "0001-01-01 00:00:00"),
    (2936549.9, "9999-12-31 00:00:00"),
    (-715510.0, None),
    (2936550.0, None),
    (math.nan, None),
    (math.inf, None),
    (-math.inf, None),
    (1e18, None),
    (None, None),
]

MDY_CASES = [
    ("10282016", "2016-10-28 00:00:00"),
    ("02292016", "2016-02-29 00:00:00"),
    ("1282016", "2016-12-08 00:00:00"),
    ("1302016", "2016-01-30 00:00:00"),
    ("112016", "2016-01-01 00:00:00"),
    ("1112016", "2016-11-01 00:00:00"),
    ("10 82016", "2016-10-08 00:00:00"),
] + [
    (text, None)
    for text in (
        "D/S", "", "02302016", "02292015", "13012016", "01010000", "012916",
        "1/2/2016", " 10282016", "10282016 ", "10282016\n", None,
    )
]


def apply(spark, values, kind, function):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    rows = frame.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [row.y for row in rows]


def test_day_numbers(spark):
    values, expected = zip(*DAY_CASES)
    assert apply(spark, values, "double", day_number_to_text) == list(expected)


def test_mdy(spark):
    values, expected = zip(*MDY_CASES)
    assert apply(spark, values, "string", mdy_to_text) == list(expected)


def test_typed_variants(spark):
    assert apply(spark, [20573.9], "double", day_number_to_date) == [
        datetime.date(2016, 4, 29)
    ]
    assert apply(spark, ["D/S", "1282016"], "string", mdy_to_date) == [
        None,
        datetime.date(2016, 12, 8),
    ]


def python_days(x):
    try:
        return str(datetime.datetime(1960, 1, 1) + datetime.timedelta(days=int(x)))
    except (TypeError, ValueError, OverflowError):
        return None


def python_mdy(x):
    try:
        return str(datetime.datetime.strptime(x, "%m%d%Y"))
    except (TypeError, ValueError):
        return None


relaxed = settings(
    max_examples=8, deadline=None, suppress_health_check=list(HealthCheck)
)


@relaxed
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.floats(),
            st.floats(min_value=-720000, max_value=2940000),
            st.integers(min_value=-720000, max_value=2940000).map(float),
        ),
        min_size=200,
        max_size=400,
    )
)
def test_day_numbers_agree_with_python(spark, values):
    expected = [python_days(x) for x in values]
    assert apply(spark, values, "double", day_number_to_text) == expected


@relaxed
@given(
    st.lists(
        st.one_of(
            st.text(alphabet="0123456789 ", min_size=5, max_size=9),
            st.text(alphabet="0123", min_size=6, max_size=8),
            st.dates().map(lambda d: f"{d.month:02d}{d.day:02d}{d.year:04d}"),
            st.dates().map(lambda d: f"{d.month}{d.day}{d.year:04d}"),
            st.dates().map(lambda d: f"{d.month}{d.day:2d}{d.year:04d}"),
        ),
        min_size=200,
        max_size=400,
    )
)
def test_mdy_agrees_with_python(spark, values):
    expected = [python_mdy(x) for x in values]
    assert apply(spark, values, "string", mdy_to_text) == expected


@pytest.mark.parametrize(
    "day, tag",
    [("2019-09-01", "sep19"), ("2016-04-30", "apr16"), ("2005-12-31", "dec05")],
)
def test_month_tag(spark, day, tag):
    row = spark.sql(f"SELECT DATE '{day}' AS d").select(month_tag(F.col("d"))).first()
    assert row[0] == tag
    assert tag_of(datetime.date.fromisoformat(day)) == tag
