"""A month's own columns against the expected ones."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.schemas import RAW_FACT_SCHEMA
from landfall.sources.contract import SchemaDrift, compare, conform, parquet_groups, read_conforming

EXPECTED = T.StructType().add("id", "double").add("name", "string").add("day", "double")


def test_comparing_names_and_types(spark):
    found = T.StructType.fromDDL("ID bigint, nom string, day date, extra int, Extra2 int")
    drift = compare(found, EXPECTED, {"name": "nom"})
    assert drift.renamed == {"id": "ID", "name": "nom"} and drift.retyped == {"id": ("bigint", "double")}
    assert drift.refused == {"day": ("date", "double")} and drift.added == ["extra", "Extra2"]
    assert compare(T.StructType.fromDDL("id double, Name string, NAME string"), EXPECTED).ambiguous == ["name"]


def test_all_faults_are_named_at_once(spark):
    frame = spark.createDataFrame([(True, 3)], "id boolean, name int")
    with pytest.raises(SchemaDrift, match="here: missing day; id is boolean, not double; name is int, not string"):
        conform(frame, EXPECTED, source="here")
    missing = spark.createDataFrame([(1, "x")], "id int, name string")
    assert conform(missing, EXPECTED, optional=["day"]).collect() == [(1.0, "x", None)]


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint", "float", "decimal(10,2)", "string"])
def test_numbers_of_any_kind(spark, kind):
    frame = spark.sql(f"SELECT CAST(7 AS {kind}) AS id, 'x' AS name, CAST(NULL AS {kind}) AS day")
    assert conform(frame, EXPECTED).collect() == [(7.0, "x", None)]


def test_numbers_that_would_change_are_an_error(spark):
    for value in ("9007199254740993", "CAST('9007199254740993.5' AS DECIMAL(20,1))"):
        frame = spark.sql(f"SELECT {value} AS id, 'x' AS name, 1 AS day")
        with pytest.raises(Exception, match="INEXACT_NUMBER"):
            conform(frame, EXPECTED).collect()
    text = spark.sql("SELECT 'one' AS id, 'x' AS name, 1 AS day")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(text, EXPECTED).collect()


def test_files_that_differ_among_themselves(spark, tmp_path):
    path = f"{tmp_path}/month"
    spark.sql("SELECT 1.0D AS id, 'a' AS name, 2.0D AS day").write.parquet(path)
    spark.sql("SELECT 'b' AS NAME, 2L AS id, 3 AS day, 9 AS more").write.mode("append").parquet(path)
    spark.sql("SELECT 3 AS id, 'c' AS name, 4.0D AS day").write.mode("append").parquet(path)
    spark.sql("SELECT 4 AS id, 'd' AS name, 4.0D AS day").write.mode("append").parquet(path)
    assert sorted(len(g) for g in parquet_groups(spark, path)) == [1, 1, 2]
    rows = read_conforming(spark, path, "parquet", EXPECTED).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1.0, "a", 2.0), (2.0, "b", 3.0), (3.0, "c", 4.0), (4.0, "d", 4.0)]
    spark.sql("SELECT 5 AS id, 'e' AS name").write.mode("append").parquet(path)
    with pytest.raises(SchemaDrift, match="part-.*missing day"):
        read_conforming(spark, path, "parquet", EXPECTED)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(3).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_FACT_SCHEMA]
    ).write.parquet(f"{tmp_path}/m")
    frame = read_conforming(spark, f"{tmp_path}/m", "parquet", RAW_FACT_SCHEMA)
    plan = frame.filter("i94mon = 4").select("cicid")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(i94mon), EqualTo(i94mon,4.0)]" in plan
    assert "ReadSchema: struct<cicid:double,i94mon:double>" in plan
