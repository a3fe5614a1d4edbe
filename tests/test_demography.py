"""City and state rollups."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from landfall.operators.demography import demography_by_city, demography_by_state
from landfall.schemas import RAW_DEMOGRAPHY_SCHEMA

ROWS = [
    ("Alpha", "Ohio", 30.0, 100, "White", 60),
    ("Alpha", "Ohio", 30.0, 100, "Asian", 5),
    ("Beta", "Ohio", 40.0, 200, "Black", 70),
    ("Springfield", "Missouri", 33.0, 80, "White", 50),
    ("Springfield", "Illinois", 35.0, 120, "White", 90),
    ("Gamma", "Utah", 20.0, None, "White", 10),
    (None, "Utah", 50.0, 10, "White", 1),
]


def frame(spark, rows=ROWS):
    full = []
    for city, state, age, male, race, count in rows:
        other = [float(male) if male is not None else None] * 5
        full.append((city, state, age, *other, 2.5, count, race))
    return spark.createDataFrame(full, RAW_DEMOGRAPHY_SCHEMA).repartition(3)


def facts(df):
    return {
        row["City"] if "City" in df.columns else row["State"]: (
            row["State"], row["Median Age"], row["Male Population"], row["Count"], row["Race"],
        )
        for row in df.collect()
    }


def test_by_city(spark):
    assert facts(demography_by_city(frame(spark))) == {
        "ALPHA": ("OHIO", 30.0, 100.0, 65, "Asian / White"),
        "BETA": ("OHIO", 40.0, 200.0, 70, "Black"),
        "GAMMA": ("UTAH", 20.0, None, 10, "White"),
        "SPRINGFIELD": ("ILLINOISMISSOURI", 34.0, 100.0, 140, "White"),
    }


@pytest.mark.parametrize(
    "options, ohio",
    [({}, "Asian / Black / White"), ({"glue": ""}, "Asian / WhiteBlack")],
)
def test_by_state(spark, options, ohio):
    cities = demography_by_city(frame(spark))
    assert facts(demography_by_state(cities, **options)) == {
        "ILLINOISMISSOURI": ("ILLINOISMISSOURI", 34.0, 100.0, 140, "White"),
        "OHIO": ("OHIO", 35.0, 300.0, 135, ohio),
        "UTAH": ("UTAH", 20.0, 0.0, 10, "White"),
    }


def test_spellings_merge_before_grouping(spark):
    rows = [*ROWS, ("alpha", "Ohio", 60.0, 100, "White", 1)]
    result = facts(demography_by_city(frame(spark, rows)))
    assert result["ALPHA"] == ("OHIO", 40.0, 100.0, 66, "Asian / White")


def test_homonyms_kept_apart_on_request(spark):
    result = demography_by_city(frame(spark), ("City", "State"))
    rows = {(r["City"], r["State"]): r["Median Age"] for r in result.collect()}
    assert rows[("SPRINGFIELD", "MISSOURI")] == 33.0
    assert rows[("SPRINGFIELD", "ILLINOIS")] == 35.0
    assert len(rows) == 5


def test_column_order(spark):
    assert demography_by_city(frame(spark)).columns == [
        "City", "State", "Median Age", "Male Population", "Female Population",
        "Total Population", "Number of Veterans", "Foreign-born",
        "Average Household Size", "Count", "Race",
    ]
    assert demography_by_state(demography_by_city(frame(spark))).columns == [
        "State", "Median Age", "Male Population", "Female Population",
        "Total Population", "Number of Veterans", "Foreign-born",
        "Average Household Size", "Count", "Race",
    ]


def test_missing_race_state_and_nan(spark):
    rows = [
        ("A", None, 1.0, 1, None, 1),
        ("A", "X", float("nan"), 3, "White", None),
        ("B", "X", None, None, None, None),
    ]
    result = facts(demography_by_city(frame(spark, rows)))
    assert result == {"A": ("X", 1.0, 2.0, 1, "White"), "B": ("X", None, None, 0, None)}


def test_agrees_with_pandas_on_a_hot_city(spark):
    """A third of the rows in one city; measures against pandas."""
    raw = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("C"), F.col("id") % 700)).alias("City"),
        F.concat(F.lit("S"), F.col("id") % 5).alias("State"),
        *[
            F.when(F.col("id") % 7 != i, (F.col("id") % 1000).cast("double")).alias(f.name)
            for i, f in enumerate(RAW_DEMOGRAPHY_SCHEMA.fields[2:9])
        ],
        (F.col("id") % 50).alias("Count"),
        F.concat(F.lit("R"), F.col("id") % 4).alias("Race"),
    )
    ours = demography_by_city(raw).toPandas().set_index("City").sort_index()
    local = raw.toPandas()
    local["City"] = local["City"].str.upper()
    grouped = local.groupby("City")
    for column in RAW_DEMOGRAPHY_SCHEMA.names[2:9]:
        pd.testing.assert_series_equal(
            ours[column], grouped[column].mean(), check_names=False, check_dtype=False
        )
    assert (ours["Count"] == grouped["Count"].sum()).all()
    joined = grouped["Race"].apply(lambda s: " / ".join(sorted(set(s))))
    assert (ours["Race"] == joined).all()
