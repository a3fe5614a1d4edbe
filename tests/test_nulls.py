"""Missing values, airport cleaning and delimited files."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from landfall.operators.airport import clean_airport
from landfall.operators.nulls import NA_TOKENS, drop_null_keys, fill_none, normalize_na
from landfall.sources.readers import (
    read_airports,
    read_delimited,
    read_demography,
    read_headerless,
)
from landfall.sources.writers import write_delimited

AIRPORT_HEADER = (
    "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,"
    "gps_code,iata_code,local_code,coordinates"
)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def airport_file(tmp_path):
    return write(
        tmp_path / "airports.csv",
        AIRPORT_HEADER,
        '00A,heliport,Total Rf,11,NA,US,US-PA,Bensalem,00A,,n/a,"-74.9, 40.0"',
        '0BB,small_airport,"The ""Old"" Field",,AF,NA,NA-KH,,NULL,XYZ,LL,"17.0, -22.4"',
    )


@pytest.mark.parametrize("legacy", [False, True])
def test_airports(spark, tmp_path, legacy):
    frame = read_airports(
        spark, airport_file(tmp_path), {"airport_type": "type"}, legacy_na=legacy
    )
    rows = {r.ident: r for r in clean_airport(frame).collect()}
    first, second = rows["00A"], rows["0BB"]
    assert first.airport_type == "heliport"
    assert first.elevation_ft == "11.0"
    assert second.elevation_ft == "None"
    assert first.iata_code == "None"
    assert first.local_code == "None"
    assert first.continent == ("None" if legacy else "NA")
    assert second.iso_country == ("None" if legacy else "NA")
    assert second.gps_code == "None"
    assert second.municipality == "None"
    assert second.name == 'The "Old" Field'
    assert first.coordinates == "-74.9, 40.0"
    assert all(isinstance(value, str) for row in rows.values() for value in row)


def test_every_token_is_missing(spark):
    frame = spark.createDataFrame([(t, t) for t in (*NA_TOKENS, "na", " NA")], "a string, b string")
    rows = normalize_na(frame, ["a"]).collect()
    assert [r.a for r in rows] == [None] * len(NA_TOKENS) + ["na", " NA"]
    assert all(r.b is not None for r in rows)


def test_fill_none_covers_null_and_nan(spark):
    frame = spark.createDataFrame(
        [(1, 1.0, "x"), (None, float("nan"), None), (3, None, "")], "a int, b double, c string"
    )
    assert [tuple(r) for r in fill_none(frame).collect()] == [
        ("1", "1.0", "x"),
        ("None", "None", "None"),
        ("3", "None", ""),
    ]


def test_drop_null_keys(spark):
    frame = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert drop_null_keys(frame, "k").count() == 1


def test_columns_come_by_name_and_extra_ones_are_ignored(spark, tmp_path):
    path = write(
        tmp_path / "d.csv",
        "Race;City;State;Median Age;Male Population;Female Population;Total Population;"
        "Number of Veterans;Foreign-born;Average Household Size;State Code;Count",
        "White;Alpha;Ohio;30.5;100;NA;nan;;5;2.6;OH;60",
    )
    row = read_demography(spark, path).first()
    assert row["City"] == "Alpha" and row["Race"] == "White"
    assert row["Median Age"] == 30.5 and row["Count"] == 60
    assert row["Female Population"] is None and row["Total Population"] is None
    assert row["Number of Veterans"] is None


def test_missing_column_and_bad_number_are_errors(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b", "1,zwei")
    wanted = T.StructType([T.StructField("c", T.StringType())])
    with pytest.raises(AnalysisException):
        read_delimited(spark, path, wanted)
    number = T.StructType([T.StructField("b", T.DoubleType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_delimited(spark, path, number).collect()


def test_quotes_separators_and_line_breaks_survive(spark, tmp_path):
    rows = [('a "quoted" word', 1.5), ("semi;colon, comma", 2.0), ("two\nlines", 3.0)]
    frame = spark.createDataFrame(rows, "s string, x double")
    for sep in ",;":
        path = str(tmp_path / f"out{ord(sep)}")
        write_delimited(frame, path, sep=sep)
        back = read_delimited(spark, path, frame.schema, sep=sep, multiline=True)
        assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_sorted_folder(spark, tmp_path):
    frame = spark.range(1000).selectExpr("cast(1000 - id as string) k", "id").repartition(5)
    write_delimited(frame, str(tmp_path / "s"), sort_by=["k"])
    keys = []
    for file in sorted((tmp_path / "s").glob("part-*")):
        lines = file.read_text().splitlines()
        assert lines[0] == "k,id"
        keys += [line.split(",")[0] for line in lines[1:]]
    assert keys == sorted(keys) and len(keys) == 1000


def test_headerless_parts_lose_no_row(spark, tmp_path):
    frame = spark.range(10).selectExpr("id", "cast(id as string) s").repartition(4)
    frame.write.csv(str(tmp_path / "h"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
    assert read_headerless(spark, str(tmp_path / "h"), schema).count() == 10
