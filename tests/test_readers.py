"""Delimited text: by header name, and nothing dropped in silence."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.fact import clean_fact
from landfall.schemas import NUMERIC, RAW_FACT_SCHEMA
from landfall.sources.readers import fact_text_schema, read_delimited, read_month, scan_fact
from landfall.sources.writers import write_month

SCHEMA = T.StructType([T.StructField("City", T.StringType()), T.StructField("n", T.IntegerType())])


def read(spark, tmp_path, *files, columns=("City", "n"), **options):
    for k, text in enumerate(files):
        (tmp_path / f"{k}.csv").write_text(text)
    frame = read_delimited(spark, str(tmp_path), SCHEMA, **options).select(*columns)
    return sorted(map(tuple, frame.collect()))


def test_columns_by_name(spark, tmp_path):
    files = ("n,extra,City\n1,x,A\n", "n,extra,City\n2,y,B\n")
    assert read(spark, tmp_path, *files) == [("A", 1), ("B", 2)]


@pytest.mark.parametrize("columns", [("City", "n"), ("City",), ()])
@pytest.mark.parametrize(
    "files",
    [
        ("City,n\nA,1\n", "n,City\n2,B\n"),
        ("City,n\nA,1\n", "City,m\nB,2\n"),
        ("City,n\nA,1,x\n",),
        ("City,n\nA\n",),
        ('City,n\n"A\nB",1\n',),
    ],
    ids=["order", "name", "long", "short", "line break"],
)
def test_misfits_are_errors_whichever_columns_are_used(spark, tmp_path, files, columns):
    with pytest.raises(Exception):
        read(spark, tmp_path, *files, columns=columns)


def test_bad_numbers_and_missing_columns_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read(spark, tmp_path, "City,n\nA,x\n")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        read(spark, tmp_path, "City,m\nA,1\n")


def test_line_breaks_on_request(spark, tmp_path):
    assert read(spark, tmp_path, 'City,n\n"A\nB",1\n', multiline=True) == [("A\nB", 1)]


def test_bad_numbers_stop_sessions_that_had_ansi_off(spark, tmp_path):
    from landfall.session import configure

    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        configure(spark)
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            read(spark, tmp_path, "City,n\nA,x\n")
    finally:
        configure(spark)


def test_facts_by_header_name(spark, tmp_path):
    names = RAW_FACT_SCHEMA.names
    names = [*names[:6], "arrdate", *[n for n in names[6:] if n != "arrdate"], "more"]
    numbers = {f.name for f in RAW_FACT_SCHEMA if f.dataType == T.DoubleType()}
    values = ["20545" if n == "arrdate" else "2" if n in numbers else "NA" for n in names]
    (tmp_path / "i94_sep19.csv").write_text(";".join(names) + "\n" + ";".join(values) + "\n")
    raw = scan_fact(spark, f"{tmp_path}/i94_{{}}.csv", "sep19", "csv", {"sep": ";"})
    row = clean_fact(raw).first()
    assert (row.i94mode, row.arrival_date, row.i94addr) == (2.0, "2016-04-01 00:00:00", "NA")
    assert raw.select(F.count("*")).first()[0] == 1


def test_a_month_staged_as_text_keeps_line_breaks(spark, tmp_path):
    names = [f.name for f in fact_text_schema()]
    row = tuple(1 if f.dataType == NUMERIC else f"a\n\"{f.name}\", b" for f in fact_text_schema())
    schema = ", ".join(f"{f.name} {'int' if f.dataType == NUMERIC else 'string'}" for f in fact_text_schema())
    facts = spark.createDataFrame([row] * 3, schema)
    path = write_month(facts, str(tmp_path), "sep19", format="csv")
    rows = read_month(spark, path, "csv", multiline=True).select(*names).collect()
    assert [tuple(r) for r in rows] == [row] * 3
    with pytest.raises(Exception, match="MALFORMED"):
        read_month(spark, path, "csv").collect()
