"""Every operator as a query over the given tables, next to its SQL check."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.functions import (
    day_number_to_text,
    mdy_to_text,
    month_tag,
    to_numeric,
    too_long,
)
from landfall.operators import star
from landfall.operators.airport import clean_airport
from landfall.operators.demography import (
    demography_by_city,
    demography_by_state,
    rollup,
)
from landfall.operators.fact import clean_fact
from landfall.operators.joins import attach, attach_many, sized_broadcast, unmatched
from landfall.operators.labels import (
    BLOCKS,
    label_headers,
    label_tables,
    parse_labels,
    split_ports,
)
from landfall.operators.nulls import NA_TOKENS, fill_none, normalize_na
from landfall.operators.quality import (
    duplicate_keys,
    duplicate_keys_by_hash,
    key_report,
    key_report_by_hash,
    load_report,
)
from landfall.plans import shapes
from landfall.plans.month import Inputs, run_month
from landfall.plans.shapes import ANSI, SPARK, load
from landfall.session import configure, materialize, scratch_path
from landfall.sources import warehouse
from landfall.sources.journal import Conflict
from landfall.sources.readers import (
    read_airports,
    read_delimited,
    read_demography,
    read_lines,
    read_month,
    scan_fact,
)
from landfall.sources.writers import write_delimited, write_month

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL to match."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        QUERIES[function.__name__] = run
        ORACLES[function.__name__] = sql
        return function

    return register


# ---------------------------------------------------------------- dates

DAY_TEXT_SQL = """
CASE WHEN {0} > -715510 AND {0} < 2936550
     THEN strftime(DATE '1960-01-01' + CAST(trunc({0}) AS INTEGER), '%Y-%m-%d')
          || ' 00:00:00' END
"""

MDY_REGEX = r"^(1[0-2]|0[1-9]|[1-9])(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])(\d{4})\z"
MDY_TEXT_SQL = f"""
CASE WHEN regexp_matches({{0}}, '{MDY_REGEX}')
      AND regexp_extract({{0}}, '{MDY_REGEX}', 3) <> '0000'
     THEN strftime(try_strptime(
            regexp_extract({{0}}, '{MDY_REGEX}', 3) || '-'
            || lpad(regexp_extract({{0}}, '{MDY_REGEX}', 1), 2, '0') || '-'
            || lpad(trim(regexp_extract({{0}}, '{MDY_REGEX}', 2)), 2, '0'),
            '%Y-%m-%d'), '%Y-%m-%d') || ' 00:00:00' END
""".replace("{4}", "{{4}}")


@query(f"""
WITH raw AS (SELECT o_orderkey, {ANSI.expand(shapes.DAY_NUMBER)} AS d FROM orders)
SELECT o_orderkey, {DAY_TEXT_SQL.format("d")} AS arrival_date FROM raw
""")
def sas_days_to_datetime(spark, folder):
    days = F.expr(SPARK.expand(shapes.DAY_NUMBER))
    return load(spark, folder, "orders").select(
        "o_orderkey", day_number_to_text(days).alias("arrival_date")
    )


@query(f"""
WITH raw AS (SELECT o_orderkey, {ANSI.expand(shapes.MDY_TEXT)} AS x FROM orders)
SELECT o_orderkey, {MDY_TEXT_SQL.format("x")} AS allowedtostay_date FROM raw
""")
def mdy_to_datetime(spark, folder):
    text = F.expr(SPARK.expand(shapes.MDY_TEXT))
    raw = load(spark, folder, "orders").select("o_orderkey", text.alias("x"))
    return raw.select("o_orderkey", mdy_to_text(F.col("x")).alias("allowedtostay_date"))


@query("""
SELECT lower(strftime(o_orderdate, '%b%y')) AS tag, count(*) AS n_orders
FROM orders GROUP BY 1
""")
def month_tags(spark, folder):
    tag = month_tag(F.col("o_orderdate")).alias("tag")
    return load(spark, folder, "orders").groupBy(tag).agg(F.count("*").alias("n_orders"))


# ---------------------------------------------------------------- cleaning

CLEAN_FACT_SQL = f"""
SELECT {", ".join(schemas.FACT_COLUMNS[:22])},
       {DAY_TEXT_SQL.format("arrdate")} AS arrival_date,
       {DAY_TEXT_SQL.format("depdate")} AS departure_date,
       {MDY_TEXT_SQL.format("dtaddto")} AS allowedtostay_date
FROM raw
"""


@query(f"WITH raw AS ({shapes.ARRIVALS_SQL}) {CLEAN_FACT_SQL}")
def clean_arrivals(spark, folder):
    return clean_fact(shapes.arrivals(spark, folder))


_TOKENS_SQL = ", ".join(f"'{t}'" for t in NA_TOKENS)


@query(f"""
WITH raw AS (SELECT p_partkey, {shapes.NA_NAME} AS p_name,
                    CASE WHEN p_partkey % 5 = 0 THEN 'NA' ELSE p_brand END AS p_brand
             FROM part)
SELECT p_partkey, CASE WHEN p_name NOT IN ({_TOKENS_SQL}) THEN p_name END AS p_name,
       p_brand
FROM raw
""")
def na_tokens(spark, folder):
    raw = load(spark, folder, "part").selectExpr(
        "p_partkey",
        f"{shapes.NA_NAME} AS p_name",
        "CASE WHEN p_partkey % 5 = 0 THEN 'NA' ELSE p_brand END AS p_brand",
    )
    return normalize_na(raw, ["p_name"])


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
       COALESCE(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END, 'None') AS p_name,
       COALESCE(CAST(CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS VARCHAR),
                'None') AS p_size
FROM part
""")
def fill_missing(spark, folder):
    raw = load(spark, folder, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS p_name",
        "CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS p_size",
    )
    return fill_none(raw)


AIRPORT_SHAPE = {
    "ident": "@text(c_custkey)",
    "airport_type": "lower(c_mktsegment)",
    "name": "c_name",
    "elevation_ft": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE @text(c_nationkey) END",
    "continent": "CASE WHEN c_custkey % 2 = 0 THEN 'NA' ELSE 'EU' END",
    "iso_country": "'C' || @text(c_nationkey)",
    "iso_region": "CASE WHEN c_custkey % 5 = 0 THEN 'NA' ELSE 'R' END",
    "municipality": "'Town \"' || @text(c_nationkey) || '\"'",
    "gps_code": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'G' END",
    "iata_code": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'I' END",
    "local_code": "CASE WHEN c_custkey % 6 = 0 THEN 'n/a' ELSE 'L' END",
    "coordinates": "@text(c_nationkey) || ', -' || @text(c_custkey)",
}
_AIRPORT_SQL = ", ".join(
    f"COALESCE({value}, 'None') AS {c}"
    for c, value in {
        **{c: f"CASE WHEN {c} NOT IN ({_TOKENS_SQL}) THEN {c} END" for c in AIRPORT_SHAPE},
        "elevation_ft": "elevation_ft || '.0'",
        "continent": "continent",
        "iso_country": "iso_country",
    }.items()
)


@query(f"""
WITH raw AS ({shapes.select_sql(AIRPORT_SHAPE, "customer")})
SELECT {_AIRPORT_SQL} FROM raw
""")
def airports(spark, folder):
    path = scratch_path(spark, "airports")
    raw = load(spark, folder, "customer").selectExpr(*SPARK.columns(AIRPORT_SHAPE))
    write_delimited(raw, path)
    return clean_airport(read_airports(spark, path))


# ---------------------------------------------------------------- demography


# The last bits of averaged and summed doubles depend on the order of addition,
# so both engines compare four digits. Adding the same small amount first keeps
# exact halves of the fourth digit, common among averages, from falling on
# either side by those bits.
DIGITS, NUDGE = 4, "3.7e-7"


def _settled(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value.cast("double") + F.lit(float(NUDGE)), DIGITS)


def _settled_sql(expression: str) -> str:
    return f"round({expression} + CAST({NUDGE} AS DOUBLE), {DIGITS})"


def _table_columns(df: DataFrame, table: schemas.Table) -> DataFrame:
    """The table's column names on a demography frame, measures rounded."""
    names = schemas.LOAD_NAMES[table.name]
    types = dict(table.columns)
    return df.select(
        *[
            _settled(F.col(f"`{source}`")).alias(c)
            if types[c] == schemas.NUMERIC
            else F.col(f"`{source}`").alias(c)
            for c, source in names.items()
        ]
    )


_MEASURE_SOURCES = {
    c: schemas.LOAD_NAMES[schemas.STATE_DEMOGRAPHY.name][c] for c in star.MEASURES[:-2]
}
_CITY_MEANS_SQL = ", ".join(f'avg("{s}") AS {c}' for c, s in _MEASURE_SOURCES.items())


def _city_sql(keys: str) -> str:
    state = (
        "upper(\"State\") AS state_code"
        if "State" in keys
        else """upper(string_agg(DISTINCT "State", '' ORDER BY "State")) AS state_code"""
    )
    return f"""
    SELECT upper("City") AS city, {state}, {_CITY_MEANS_SQL},
           CAST(coalesce(sum("Count"), 0) AS DOUBLE) AS count,
           string_agg(DISTINCT "Race", ' / ' ORDER BY "Race") AS race
    FROM raw WHERE "City" IS NOT NULL GROUP BY {keys}
    """


_STATE_MEANS = ("median_age", "average_household_size")


def _state_sql(glue: str) -> str:
    measures = ", ".join(
        f"avg({c}) AS {c}" if c in _STATE_MEANS else f"coalesce(sum({c}), 0) AS {c}"
        for c in star.MEASURES[:-1]
    )
    return f"""
    SELECT state_code AS state, {measures},
           array_to_string(list_sort(list_distinct(string_split(
             string_agg(DISTINCT race, '{glue}' ORDER BY race), ' / '))), ' / ') AS race
    FROM by_city WHERE state_code IS NOT NULL GROUP BY state_code
    """


_ROUNDED = ", ".join(f"{_settled_sql(c)} AS {c}" for c in star.MEASURES[:-1])
_CITY_KEYS = 'upper("City")'
BY_CITY_SQL = f"""
WITH raw AS ({shapes.DEMOGRAPHY_SQL}), by_city AS ({_city_sql(_CITY_KEYS)})
"""
BY_STATE_SQL = f"{BY_CITY_SQL}, by_state AS ({_state_sql(' / ')})"
_CITY_RESULT = f"SELECT city, state_code, {_ROUNDED}, race FROM by_city"
_STATE_RESULT = f"SELECT state, {_ROUNDED}, race FROM by_state"


@query(f"{BY_CITY_SQL} {_CITY_RESULT}")
def by_city(spark, folder):
    result = demography_by_city(shapes.demography(spark, folder))
    return _table_columns(result, schemas.CITY_DEMOGRAPHY)


@query(f"""
WITH raw AS ({shapes.DEMOGRAPHY_SQL}),
     by_city AS ({_city_sql('upper("City"), upper("State")')}) {_CITY_RESULT}
""")
def by_city_and_state(spark, folder):
    result = demography_by_city(shapes.demography(spark, folder), ("City", "State"))
    return _table_columns(result, schemas.CITY_DEMOGRAPHY)


@query(f"{BY_STATE_SQL} {_STATE_RESULT}")
def by_state(spark, folder):
    cities = demography_by_city(shapes.demography(spark, folder))
    return _table_columns(demography_by_state(cities), schemas.STATE_DEMOGRAPHY)


@query(f"""
{BY_CITY_SQL}, by_state AS ({_state_sql('')}) SELECT state, race FROM by_state
""")
def race_glued(spark, folder):
    cities = demography_by_city(shapes.demography(spark, folder))
    result = demography_by_state(cities, glue="")
    return result.select(F.col("State").alias("state"), F.col("Race").alias("race"))


@query(f"{BY_CITY_SQL} {_CITY_RESULT}")
def sorted_output(spark, folder):
    """The city result through the delimited sink, sorted by its key."""
    path = scratch_path(spark, "sorted")
    result = _table_columns(
        demography_by_city(shapes.demography(spark, folder)), schemas.CITY_DEMOGRAPHY
    )
    write_delimited(result, path, sort_by=["city"])
    return read_delimited(spark, path, result.schema)


@query(f"{BY_CITY_SQL} SELECT count(*) AS n_rows, 0 AS n_out_of_order FROM by_city")
def sorted_order(spark, folder):
    """Rows of the sorted sink that come after a larger key, over all its files."""
    path = scratch_path(spark, "order")
    result = demography_by_city(shapes.demography(spark, folder))
    write_delimited(result.select("City"), path, sort_by=["City"])
    lines = spark.read.csv(path, header=True, escape='"').select(
        "City",
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Within files row by row, and from file to file by their first and last rows.
    before = F.lag("City").over(Window.partitionBy("file").orderBy("place"))
    within = lines.withColumn("late", F.col("City") < before)
    files = within.groupBy("file").agg(
        F.count("*").alias("n"), F.count_if("late").alias("late"),
        F.min("City").alias("low"), F.max("City").alias("high"),
    )
    crossed = F.col("low") < F.lag("high").over(Window.orderBy("file"))
    return files.withColumn("crossed", crossed).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        (F.coalesce(F.sum("late"), F.lit(0)) + F.count_if("crossed")).cast("int").alias("n_out_of_order"),
    )


@query(f"{BY_CITY_SQL} {_CITY_RESULT}")
def demography_file(spark, folder):
    """Semicolon file in, city demography out."""
    path = scratch_path(spark, "demography")
    write_delimited(shapes.demography(spark, folder), path, sep=";")
    result = demography_by_city(read_demography(spark, path))
    return _table_columns(result, schemas.CITY_DEMOGRAPHY)


@query(f"""
WITH raw AS (SELECT event_type, CASE WHEN event_type <> 'click' THEN value END AS value
             FROM events)
SELECT event_type, {_settled_sql("avg(value)")} AS mean_value,
       {_settled_sql("coalesce(sum(value), 0)")} AS sum_value
FROM raw GROUP BY event_type
""")
def all_null_sum(spark, folder):
    raw = load(spark, folder, "events").selectExpr(
        "event_type",
        "CASE WHEN event_type <> 'click' THEN value END AS mean_value",
        "CASE WHEN event_type <> 'click' THEN value END AS sum_value",
    )
    result = rollup(raw, ["event_type"], ["mean_value"], ["sum_value"], {})
    return result.select(
        "event_type",
        _settled("mean_value").alias("mean_value"),
        _settled("sum_value").alias("sum_value"),
    )


# ---------------------------------------------------------------- labels


def _write_labels(spark: SparkSession, folder: str, times: int = 1) -> str:
    """Customers as label text: blocks whole within files, headers first.

    More than one time puts every block into that many files.
    """
    path = scratch_path(spark, "label-text")
    rows = load(spark, folder, "customer").selectExpr(
        f"{SPARK.expand(shapes.LABEL_KEY)} AS key",
        f"{shapes.LABEL_BLOCK} AS block",
        "c_custkey AS place",
        f"{SPARK.expand(shapes.LABEL_LINE)} AS line",
    )
    headers = (
        rows.select("key", "block")
        .distinct()
        .selectExpr(
            "key",
            "block",
            "CAST(-1 AS BIGINT) AS place",
            "'/* ' || key || ' - block ' || CAST(block AS STRING) || ' */' AS line",
        )
    )
    text = rows.unionByName(headers).repartitionByRange("key", "block")
    text = text.sortWithinPartitions("key", "block", "place").select("line")
    for _ in range(times):
        text.write.mode("append").text(path)
    return path


LABELS_SQL = f"""
WITH entries AS (
  SELECT {shapes.LABEL_KEY} AS block_key, upper({ANSI.text.format("c_custkey")}) AS code,
         upper({shapes.LABEL_VALUE}) AS value
  FROM customer WHERE c_custkey % 10 NOT IN (3, 7))
"""


@query(f"{LABELS_SQL} SELECT block_key, code, value FROM entries")
def labels_roundtrip(spark, folder):
    lines = read_lines(spark, _write_labels(spark, folder))
    return parse_labels(lines).select("block_key", "code", "value")


@query(f"""
SELECT DISTINCT {shapes.LABEL_KEY} AS block_key,
       'block ' || CAST({shapes.LABEL_BLOCK} AS VARCHAR) AS description
FROM customer
""")
def labels_headers(spark, folder):
    lines = read_lines(spark, _write_labels(spark, folder))
    return label_headers(lines).select("block_key", "description")


_PORTS_SQL = """
SELECT 'I94Port_Code' AS table_name, code, trim(string_split(value, ',')[1]) AS city,
       trim(string_split(value, ',')[2]) AS state
FROM entries WHERE block_key = 'I94PORT' AND len(string_split(value, ',')) <= 2
"""


_TABLES_SQL = (
    LABELS_SQL
    + _PORTS_SQL
    + "".join(
        f" UNION ALL SELECT '{table}', code, value, NULL FROM entries"
        f" WHERE block_key = '{key}'"
        for key, (table, columns) in BLOCKS.items()
        if len(columns) == 2
    )
)


def _label_rows(spark: SparkSession, path: str) -> DataFrame:
    """The five tables of a label text as one."""
    entries = parse_labels(read_lines(spark, path))
    tables = label_tables(materialize(spark, entries, "entries"))
    parts = []
    for name, frame in tables.items():
        columns = [F.col(c) for c in frame.columns] + [F.lit(None).cast("string")]
        code, city, state = columns[:3]
        parts.append(
            frame.select(
                F.lit(name).alias("table_name"),
                code.alias("code"),
                city.alias("city"),
                state.alias("state"),
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


@query(_TABLES_SQL)
def labels_to_tables(spark, folder):
    return _label_rows(spark, _write_labels(spark, folder))


@query(_TABLES_SQL)
def labels_repeated(spark, folder):
    """Every block in two files: each code is one row."""
    return _label_rows(spark, _write_labels(spark, folder, times=2))


@query(f"""
WITH raw AS (SELECT p_partkey, string_split({shapes.PORT_VALUE}, ',') AS pieces FROM part)
SELECT p_partkey, trim(pieces[1]) AS city, trim(pieces[2]) AS state
FROM raw WHERE len(pieces) <= 2
""")
def port_split(spark, folder):
    raw = load(spark, folder, "part").selectExpr(
        "p_partkey", f"{shapes.PORT_VALUE} AS value"
    )
    return split_ports(raw).select("p_partkey", "city", "state")


# ---------------------------------------------------------------- files


@query("SELECT * FROM customer UNION ALL SELECT * FROM customer")
def csv_roundtrip(spark, folder):
    """Written with header under both separators, read back by name."""
    customer = load(spark, folder, "customer")
    copies = []
    for sep in (",", ";"):
        path = scratch_path(spark, "csv")
        write_delimited(customer, path, sep=sep)
        names = sorted(customer.columns)
        schema = T.StructType([customer.schema[c] for c in names])
        copies.append(read_delimited(spark, path, schema, sep=sep))
    return copies[0].unionByName(copies[1])


def _fact_rows_sql(raw: str) -> str:
    """Fact rows as the table holds them, from a shape's SQL."""
    columns = ", ".join(
        f"CAST({c} AS DECIMAL(18, 0)) AS {c}" if t == schemas.NUMERIC else c
        for c, t in schemas.FACT.columns
    )
    return f"WITH raw AS ({raw}), clean AS ({CLEAN_FACT_SQL}) SELECT {columns} FROM clean"


@query(_fact_rows_sql(shapes.ARRIVALS_SQL))
def csv_month(spark, folder):
    """The cleaned month without header in many part files: no row is lost."""
    path = write_month(
        clean_fact(shapes.arrivals(spark, folder)), scratch_path(spark, "month"), "all",
        format="csv",
    )
    return read_month(spark, path, "csv")


@query(f"WITH raw AS ({shapes.ARRIVALS_SQL}) {CLEAN_FACT_SQL}")
def fact_from_csv(spark, folder):
    """The raw month as headed text, its columns in another order than the schema's."""
    base = scratch_path(spark, "fact-csv")
    raw = shapes.arrivals(spark, folder)
    names = ["ignored", *sorted(c for c in raw.columns if c != "ignored")]
    write_delimited(raw.select(*names), f"{base}/sep19")
    return clean_fact(scan_fact(spark, f"{base}/{{}}", "sep19", "csv"))


@query(f"WITH raw AS ({shapes.ARRIVALS_PER_ORDER_SQL}) {CLEAN_FACT_SQL}")
def fact_schema_drift(spark, folder):
    """A month whose files have other types, orders of columns, spellings and extra columns."""
    path = scratch_path(spark, "drift")
    raw = shapes.arrivals_per_order(spark, folder)
    kind = F.col("cicid").cast("long") % 4
    shifted = raw.select(*reversed(raw.columns), F.lit("new").alias("added"))
    forms = [
        raw,
        shifted.withColumn("cicid", F.col("cicid").cast("long")).withColumn("i94yr", F.col("i94yr").cast("int")),
        raw.withColumn("admnum", F.col("admnum").cast("decimal(15,0)").cast("string")),
        raw.toDF(*[c.upper() for c in raw.columns]).drop("OCCUP").withColumn("occup", F.lit(None)),
    ]
    for n, form in enumerate(forms):
        form.where(kind == n).write.mode("append").parquet(f"{path}/sep19")
    return clean_fact(scan_fact(spark, f"{path}/{{}}", "sep19"))


@query("""
SELECT c_custkey, c_name || chr(10) || '"' || c_mktsegment || '", x' AS label,
       CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS c_acctbal
FROM customer
""")
def csv_mixed_folder(spark, folder):
    """Many files with quoted line breaks, separators and quotes, read by name."""
    path = scratch_path(spark, "mixed")
    rows = load(spark, folder, "customer").selectExpr(
        "c_acctbal AS other",
        r"c_name || '\n\"' || c_mktsegment || '\", x' AS label",
        "CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS c_acctbal",
        "c_custkey",
    )
    write_delimited(rows.repartition(4, "c_custkey"), path)
    schema = rows.select("c_custkey", "label", "c_acctbal").schema
    return read_delimited(spark, path, schema, multiline=True)


# ---------------------------------------------------------------- warehouse


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database of its own, dropped in the end: results are written before."""
    name = f"landfall_{uuid.uuid4().hex[:12]}"
    warehouse.create_database(spark, name, scratch_path(spark, name))
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE `{name}` CASCADE")


@query("""
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS i94port_code, c_mktsegment AS state,
       c_name AS city
FROM customer
""")
def dim_refresh(spark, folder):
    """A dimension loaded twice holds the latest data only."""
    table = schemas.PORT
    ports = load(spark, folder, "customer").selectExpr(
        "'P' || CAST(c_custkey AS STRING) AS code", "c_name AS city",
        "c_mktsegment AS state",
    )
    names = {"i94port_code": "code"}
    with _database(spark) as database:
        warehouse.create_tables(spark, [table], database)
        outdated = ports.withColumn("city", F.lower("city"))
        warehouse.refresh_dimension(outdated, table, database, names)
        warehouse.refresh_dimension(ports, table, database, names)
        return materialize(spark, warehouse.read_table(spark, table, database), "result")


@query("""
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS i94port_code, c_mktsegment AS state,
       c_name AS city
FROM customer
""")
def table_recreated(spark, folder):
    """A table with rows is dropped and made anew: the old rows are gone."""
    table = schemas.PORT
    ports = load(spark, folder, "customer").selectExpr(
        "'P' || CAST(c_custkey AS STRING) AS i94port_code", "c_name AS city",
        "c_mktsegment AS state",
    )
    names = {c: c for c in table.column_names}
    with _database(spark) as database:
        for code in (F.lower("i94port_code"), F.col("i94port_code")):
            warehouse.drop_tables(spark, [table], database)
            warehouse.create_tables(spark, [table], database)
            there = warehouse.read_table(spark, table, database).select("i94port_code", "city", "state")
            rows = ports.withColumn("i94port_code", code).unionByName(there)
            warehouse.refresh_dimension(rows, table, database, names)
        return materialize(spark, warehouse.read_table(spark, table, database), "result")


def _months(facts: DataFrame) -> list[tuple[int, int]]:
    """The calendar months present: bounded by the calendar, not by the rows."""
    return [
        (int(r[0]), int(r[1])) for r in facts.select("i94yr", "i94mon").distinct().collect()
    ]


@query(_fact_rows_sql(shapes.ARRIVALS_SQL))
def fact_append(spark, folder):
    """All months at once, then one of them again: every row is there once."""
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        facts = clean_fact(shapes.arrivals(spark, folder))
        months = _months(load(spark, folder, "orders").selectExpr(
            "year(o_orderdate) AS i94yr", "month(o_orderdate) AS i94mon"))
        warehouse.load_months(facts, months, database)
        year, month = max(months)
        again = facts.filter((F.col("i94yr") == year) & (F.col("i94mon") == month))
        warehouse.load_months(again, [(year, month)], database)
        return materialize(spark, warehouse.read_table(spark, schemas.FACT, database), "result")


# Orders as facts, some of them without a key.
_GAPPED = shapes.ARRIVALS_PER_ORDER | {
    "cicid": "CASE WHEN o_orderkey % 97 > 0 THEN CAST(o_orderkey AS DOUBLE) END"
}


@query(_fact_rows_sql(shapes.select_sql(_GAPPED, "orders")))
def fact_append_new(spark, folder):
    """Partial files: half the rows, then all of them twice; none is added twice."""
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        orders = load(spark, folder, "orders").selectExpr(*SPARK.columns(_GAPPED))
        facts = clean_fact(orders)
        months = _months(facts)
        half = facts.filter((F.col("cicid") % 2) == 0)
        warehouse.load_months(half, months, database)
        for _ in range(2):
            warehouse.append_new_rows(facts, months, database)
        return materialize(spark, warehouse.read_table(spark, schemas.FACT, database), "result")


@query(_fact_rows_sql(shapes.ARRIVALS_SQL))
def csv_month_load(spark, folder):
    """Months written as text without header, loaded into the fact table."""
    path = write_month(
        clean_fact(shapes.arrivals(spark, folder)), scratch_path(spark, "month"), "all",
        format="csv",
    )
    months = _months(load(spark, folder, "orders").selectExpr(
        "year(o_orderdate) AS i94yr", "month(o_orderdate) AS i94mon"))
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        warehouse.load_months(read_month(spark, path, "csv"), months, database)
        return materialize(spark, warehouse.read_table(spark, schemas.FACT, database), "result")


@query("""
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS i94port_code, c_mktsegment AS state,
       c_name AS city
FROM customer
""")
def refresh_recovered(spark, folder):
    """Two runs are lost: one after its commit, which holds, and one before it."""
    table = schemas.PORT
    ports = load(spark, folder, "customer").selectExpr(
        "'P' || CAST(c_custkey AS STRING) AS i94port_code", "c_name AS city",
        "c_mktsegment AS state",
    )
    names = {c: c for c in table.column_names}
    with _database(spark) as database:
        warehouse.create_tables(spark, [table], database)
        warehouse.refresh_dimension(ports.withColumn("city", F.lower("city")), table, database, names)
        committed = warehouse.Replacement(spark, database)
        committed.stage(ports, table, names)
        base = warehouse.settle(spark, database)
        record = replace(base, tables=base.tables | committed.folders)
        committed.journal.commit(base, record)
        staged = warehouse.Replacement(spark, database)
        staged.stage(ports.withColumn("state", F.lit("never")), table, names)
        warehouse.recover(spark, database)
        return materialize(spark, warehouse.read_table(spark, table, database), "result")


@query(_fact_rows_sql(shapes.ARRIVALS_SQL))
def month_switched(spark, folder):
    """Months loaded; a month's new rows are written but their commit fails; loaded again."""
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        facts = clean_fact(shapes.arrivals(spark, folder))
        months = _months(load(spark, folder, "orders").selectExpr(
            "year(o_orderdate) AS i94yr", "month(o_orderdate) AS i94mon"))
        warehouse.load_months(facts, months, database)
        year, month = min(months)
        one = facts.filter((F.col("i94yr") == year) & (F.col("i94mon") == month))
        lost = warehouse.Replacement(spark, database)
        lost.stage_months(one.withColumn("fltno", F.lit("lost")), [(year, month)])
        outdated = replace(warehouse.settle(spark, database), generation=0)
        try:
            lost.switch(outdated)
        except Conflict:
            warehouse.load_months(one, [(year, month)], database)
            return materialize(spark, warehouse.read_table(spark, schemas.FACT, database), "result")
        raise AssertionError("a month was switched on top of an outdated record")


@query(_fact_rows_sql(shapes.select_sql(_GAPPED, "orders")))
def partial_merged(spark, folder):
    """Half the rows are loaded; two writers merge the same file at the same time."""
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        orders = load(spark, folder, "orders").selectExpr(*SPARK.columns(_GAPPED))
        facts = clean_fact(orders)
        months = _months(facts)
        warehouse.load_months(facts.filter(F.col("cicid") % 2 == 0), months, database)
        slow = warehouse.PartialMerge(facts, months, database)
        slow.stage()
        fast = warehouse.append_new_rows(facts.repartition(3), months, database)
        if (fast, slow.commit(), slow.run()) != (True, None, False):
            raise AssertionError("a partial file was merged twice")
        return materialize(spark, warehouse.read_table(spark, schemas.FACT, database), "result")


@query(_fact_rows_sql(shapes.ARRIVALS_PER_ORDER_SQL))
def existing_month_refused(spark, folder):
    """A month that is there is not written again in mode error."""
    base = scratch_path(spark, "refused")
    facts = clean_fact(shapes.arrivals_per_order(spark, folder))
    path = write_month(facts, base, "sep19", mode="error")
    try:
        write_month(facts.withColumn("fltno", F.lit("again")), base, "sep19", mode="error")
    except AnalysisException as refused:
        if "PATH_ALREADY_EXISTS" not in str(refused):
            raise
        return spark.read.parquet(path)
    raise AssertionError("the month was written over")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS i94port_code, c_mktsegment AS state, c_name AS city
FROM customer
""")
def load_by_name(spark, folder):
    """A file in another column order lands in the right columns."""
    path = scratch_path(spark, "ports")
    columns = ("I94port_Code", "City", "State")
    customer = load(spark, folder, "customer")
    write_delimited(
        customer.select("c_custkey", "c_name", "c_mktsegment").toDF(*columns), path
    )
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    table = schemas.PORT
    with _database(spark) as database:
        warehouse.create_tables(spark, [table], database)
        warehouse.refresh_dimension(read_delimited(spark, path, schema), table, database)
        return materialize(spark, warehouse.read_table(spark, table, database), "result")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(l_quantity / 2 AS DECIMAL(18, 0)) AS half_quantity,
       CAST(-l_quantity / 2 AS DECIMAL(18, 0)) AS minus_half,
       CAST(l_extendedprice AS DECIMAL(18, 0)) AS price
FROM lineitem
""")
def decimal_load(spark, folder):
    quantity, double = F.col("l_quantity"), T.DoubleType()
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        to_numeric(quantity / 2, double).alias("half_quantity"),
        to_numeric(-quantity / 2, double).alias("minus_half"),
        to_numeric(F.col("l_extendedprice"), double).alias("price"),
    )


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def varchar_guard(spark, folder):
    part = load(spark, folder, "part").select("p_partkey", "p_name")
    return part.filter(too_long(F.col("p_name"), 10))


_NAMES = {"i94port_code": "c_custkey", "state": "c_name", "city": "c_acctbal"}


@query("""
SELECT 'i94port_code' AS "column", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_null,
       CAST(sum(CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_misfit
FROM customer
UNION ALL SELECT 'state', count(*), CAST(sum(CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT), 0
FROM customer
UNION ALL SELECT 'city', count(*), 0, 0 FROM customer
""")
def load_report_ports(spark, folder):
    """What would stop a load, and gaps, for each column of a table."""
    rows = load(spark, folder, "customer").selectExpr(
        "CASE WHEN c_custkey % 10 = 0 THEN repeat('x', 257) ELSE CAST(c_custkey AS STRING) END"
        " AS c_custkey",
        "CASE WHEN c_custkey % 7 > 0 THEN c_name END AS c_name",
        "c_acctbal",
    )
    return load_report(rows, schemas.PORT, _NAMES)


@query("""
SELECT 'i94mode_code' AS "column", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_null,
       CAST(sum(CASE WHEN p_partkey % 4 = 0 OR p_partkey % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT)
         AS n_misfit
FROM part UNION ALL SELECT 'transportation', count(*), 0, 0 FROM part
""")
def load_report_modes(spark, folder):
    rows = load(spark, folder, "part").selectExpr(
        "CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 9 = 0 THEN '1e19'"
        " ELSE CAST(p_partkey AS STRING) END AS i94mode_code",
        "p_name AS transportation",
    )
    return load_report(rows, schemas.MODE, {})


# ---------------------------------------------------------------- joins


@query("""
SELECT c.n_name AS citizenship, r.n_name AS residence, count(*) AS arrivals,
       sum(l_quantity) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation c ON c_nationkey = c.n_nationkey
LEFT JOIN nation r ON s_nationkey = r.n_nationkey
GROUP BY 1, 2
""")
def role_playing_join(spark, folder):
    """One dimension in two roles, attached to counts rather than to rows."""
    lineitem, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    customer, supplier = load(spark, folder, "customer"), load(spark, folder, "supplier")
    nation = load(spark, folder, "nation")
    counts = (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    )
    labelled = attach(
        counts, nation, {"c_nationkey": "n_nationkey"}, {"n_name": "citizenship"}
    )
    labelled = attach(
        labelled, nation, {"s_nationkey": "n_nationkey"}, {"n_name": "residence"}
    )
    return labelled.groupBy("citizenship", "residence").agg(
        F.sum("n").alias("arrivals"), F.sum("q").alias("quantity")
    )


STAR_JOIN_SQL = f"""
WITH raw AS ({shapes.ARRIVALS_SQL}),
     countries AS ({shapes.STAR_SQL["I94CIT_I94RES_Code"]}),
     ports AS ({shapes.STAR_SQL["I94Port_Code"]}),
     modes AS ({shapes.STAR_SQL["I94Mode_Code"]}),
     addresses AS ({shapes.STAR_SQL["I94Addr_Code"]}),
     visas AS ({shapes.STAR_SQL["I94Visa_Code"]}),
     joined AS (
       SELECT raw.*, c.country AS citizenship, r.country AS residence,
              ports.city AS port_city, ports.state AS port_state, transportation,
              addresses.state AS destination, visas.visatype AS visa_category
       FROM raw LEFT JOIN countries c ON i94cit = c."i94CIT_i94RES_code"
       LEFT JOIN countries r ON i94res = r."i94CIT_i94RES_code"
       LEFT JOIN ports ON i94port = i94port_code
       LEFT JOIN modes ON i94mode = i94mode_code
       LEFT JOIN addresses ON i94addr = i94addr_code
       LEFT JOIN visas ON i94visa = i94visa_code)
"""
_ROLE_COLUMNS = [name for r in star.ROLES.values() for name in r.attributes.values()]


@query(f"""{STAR_JOIN_SQL}
SELECT cicid, fltno, i94port, i94mode, {", ".join(_ROLE_COLUMNS)} FROM joined
""")
def star_join(spark, folder):
    facts = clean_fact(shapes.arrivals(spark, folder))
    enriched = star.enrich(facts, shapes.star_tables(spark, folder))
    return enriched.select("cicid", "fltno", "i94port", "i94mode", *_ROLE_COLUMNS)


@query(f"""{STAR_JOIN_SQL}
SELECT citizenship, visa_category, CAST(i94yr AS INTEGER) AS i94yr,
       CAST(i94mon AS INTEGER) AS i94mon, count(*) AS arrivals
FROM joined GROUP BY 1, 2, 3, 4
""")
def arrivals_by_country_visa_month(spark, folder):
    facts = clean_fact(shapes.arrivals(spark, folder))
    counts = star.arrivals_by(
        facts, shapes.star_tables(spark, folder), ["citizenship", "visa"],
        ["i94yr", "i94mon"],
    )
    return counts.withColumns(
        {c: F.col(c).cast("int") for c in ("i94yr", "i94mon")}
    )


@query(f"""{STAR_JOIN_SQL}
SELECT port_city, destination, transportation, residence, count(*) AS arrivals
FROM joined GROUP BY 1, 2, 3, 4
""")
def arrivals_by_port_and_destination(spark, folder):
    facts = clean_fact(shapes.arrivals(spark, folder))
    return star.arrivals_by(
        facts,
        shapes.star_tables(spark, folder),
        ["port", "destination", "mode", "residence"],
    ).groupBy("port_city", "destination", "transportation", "residence").agg(
        F.sum("arrivals").alias("arrivals")
    )


@query(f"""{BY_STATE_SQL}
SELECT c_custkey, n.n_name AS city, r.r_name AS state,
       {_settled_sql("s.total_population")} AS state_total_population,
       s.race AS state_race, {_settled_sql("t.median_age")} AS city_median_age
FROM customer LEFT JOIN nation n ON c_nationkey = n_nationkey
LEFT JOIN region r ON n_regionkey = r_regionkey
LEFT JOIN by_state s ON r.r_name = s.state
LEFT JOIN by_city t ON n.n_name = t.city
""")
def snowflake_join(spark, folder):
    """Demography attached to the code tables, then one join to the facts."""
    by_city_frame = materialize(
        spark, demography_by_city(shapes.demography(spark, folder)), "city"
    )
    by_state_frame = demography_by_state(by_city_frame)
    cities = by_city_frame.toDF("city", "state_code", *star.MEASURES)
    states = by_state_frame.toDF("state", *star.MEASURES)
    nation = load(spark, folder, "nation").withColumnRenamed("n_name", "city")
    region = load(spark, folder, "region").withColumnRenamed("r_name", "state")
    codes = attach(nation, region, {"n_regionkey": "r_regionkey"}, {"state": "state"})
    codes = star.states_with_demography(codes, states)
    codes = star.ports_with_demography(codes, cities)
    codes = materialize(spark, codes, "codes")
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    wanted = (
        "city", "state", "state_total_population", "state_race", "city_median_age"
    )
    joined = attach(
        customer,
        sized_broadcast(codes),
        {"c_nationkey": "n_nationkey"},
        {c: c for c in wanted},
    )
    return joined.drop("c_nationkey").withColumns(
        {c: _settled(c) for c in ("state_total_population", "city_median_age")}
    )


@query("""
WITH airports AS (
  SELECT CASE WHEN c_nationkey % 4 <> 1 THEN upper(n_name) END AS town, c_name, c_custkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_nationkey, n_name, c_name AS airport_name,
       CAST(c_custkey AS VARCHAR) AS airport_ident
FROM nation LEFT JOIN airports ON upper(n_name) = town
""")
def fanout_join(spark, folder):
    nation, customer = load(spark, folder, "nation"), load(spark, folder, "customer")
    side = customer.join(
        nation.withColumnRenamed("n_name", "town"),
        F.col("c_nationkey") == F.col("n_nationkey"),
    ).selectExpr(
        "CASE WHEN c_nationkey % 4 <> 1 THEN lower(town) END AS municipality",
        "CAST(c_custkey AS STRING) AS ident", "c_name AS name",
        "CAST(NULL AS STRING) AS iata_code", "c_mktsegment AS airport_type",
    )
    ports = nation.select("n_nationkey", "n_name", F.col("n_name").alias("city"))
    return star.ports_with_airports(ports, side).select(
        "n_nationkey", "n_name", "airport_name", "airport_ident"
    )


@query("""
SELECT s_suppkey, l_orderkey, l_linenumber, l_quantity
FROM supplier LEFT JOIN lineitem
  ON s_suppkey = CASE WHEN l_suppkey % 3 > 0 THEN l_suppkey ELSE -l_suppkey END
""")
def one_to_many_join(spark, folder):
    """Lines of every third supplier have a key that no supplier has."""
    lines = load(spark, folder, "lineitem").selectExpr(
        "CASE WHEN l_suppkey % 3 > 0 THEN l_suppkey ELSE -l_suppkey END AS l_suppkey",
        "l_orderkey", "l_linenumber", "l_quantity",
    )
    suppliers = load(spark, folder, "supplier").select("s_suppkey")
    return attach_many(suppliers, lines, {"s_suppkey": "l_suppkey"}).drop("l_suppkey")


# ---------------------------------------------------------------- quality


@query("""
SELECT o_custkey, count(*) AS n_rows
FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM customer
  WHERE CASE WHEN c_custkey % 3 > 0 THEN c_custkey ELSE -c_custkey END = o_custkey)
GROUP BY o_custkey
""")
def unmatched_customers(spark, folder):
    known = load(spark, folder, "customer").selectExpr(
        "CASE WHEN c_custkey % 3 > 0 THEN c_custkey ELSE -c_custkey END AS c_custkey"
    )
    return unmatched(load(spark, folder, "orders"), known, {"o_custkey": "c_custkey"})


_ROLE_TABLES = {
    "I94CIT_I94RES_Code": "countries",
    "I94Port_Code": "ports",
    "I94Mode_Code": "modes",
    "I94Addr_Code": "addresses",
    "I94Visa_Code": "visas",
}


def _unmatched_sql(name: str, role: star.Role) -> str:
    numeric = dict(schemas.FACT.columns)[role.fact_key] == schemas.NUMERIC
    code = f"CAST(CAST({role.fact_key} AS BIGINT) AS VARCHAR)" if numeric else role.fact_key
    return f"""
    SELECT '{name}' AS role, {code} AS code, count(*) AS n_rows
    FROM raw ANTI JOIN {_ROLE_TABLES[role.table]} d ON {role.fact_key} = d."{role.table_key}"
    WHERE {role.fact_key} IS NOT NULL GROUP BY 2
    """


@query(
    STAR_JOIN_SQL
    + " UNION ALL ".join(_unmatched_sql(n, r) for n, r in star.ROLES.items())
)
def unmatched_codes(spark, folder):
    facts = clean_fact(shapes.arrivals(spark, folder))
    return star.unmatched_codes(facts, shapes.star_tables(spark, folder))


def _code_counts_sql(role: star.Role, name: str) -> str:
    numeric = dict(schemas.FACT.columns)[role.fact_key] == schemas.NUMERIC
    code = f"CAST(CAST({role.fact_key} AS BIGINT) AS VARCHAR)" if numeric else role.fact_key
    return f"""
    SELECT CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
           '{name}' AS role, {code} AS code, count(*) AS n_rows
    FROM raw WHERE {role.fact_key} IS NOT NULL GROUP BY 1, 2, 4
    """


@query(
    f"WITH raw AS ({shapes.ARRIVALS_SQL})"
    + " UNION ALL ".join(_code_counts_sql(r, n) for n, r in star.ROLES.items())
)
def codes_by_month(spark, folder):
    """Counted while months are loaded, one of them twice; the facts are not read again."""
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        facts = clean_fact(shapes.arrivals(spark, folder))
        months = _months(load(spark, folder, "orders").selectExpr(
            "year(o_orderdate) AS i94yr", "month(o_orderdate) AS i94mon"))
        year, month = min(months)
        one = facts.filter((F.col("i94yr") == year) & (F.col("i94mon") == month))
        outdated = one.withColumn("i94port", F.lit("OLD"))
        warehouse.load_months(facts.unionByName(outdated), months, database)
        warehouse.load_months(one, [(year, month)], database)
        counts = warehouse.codes_by_month(spark, database).withColumns(
            {c: F.col(c).cast("int") for c in ("i94yr", "i94mon")}
        )
        return materialize(spark, counts, "result")


@query(f"""{STAR_JOIN_SQL}
SELECT citizenship, visa_category, CAST(i94yr AS INTEGER) AS i94yr,
       CAST(i94mon AS INTEGER) AS i94mon, count(*) AS arrivals
FROM joined WHERE i94mon IN (6, 7, 8) GROUP BY 1, 2, 3, 4
""")
def arrivals_pruned(spark, folder):
    """Arrivals of one season out of the stored fact table, which is read for it alone."""
    with _database(spark) as database:
        warehouse.create_tables(spark, [schemas.FACT], database)
        orders = load(spark, folder, "orders")
        months = _months(orders.selectExpr(
            "year(o_orderdate) AS i94yr", "month(o_orderdate) AS i94mon"))
        warehouse.load_months(clean_fact(shapes.arrivals(spark, folder)), months, database)
        calendar = materialize(spark, star.calendar(months, spark), "calendar")
        summer = calendar.where("season = 'summer'")
        stored = warehouse.read_table(spark, schemas.FACT, database)
        counts = star.arrivals_by(
            star.in_months(stored, summer), shapes.star_tables(spark, folder),
            ["citizenship", "visa"], ["i94yr", "i94mon"],
        )
        counts = counts.withColumns({c: F.col(c).cast("int") for c in ("i94yr", "i94mon")})
        return materialize(spark, counts, "result")


@query("""
SELECT l_suppkey, l_shipdate, l_returnflag, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1
""")
def pk_check_hashed(spark, folder):
    """The key check in two passes, on a wide key that often repeats."""
    lines = load(spark, folder, "lineitem")
    return duplicate_keys_by_hash(lines, ["l_suppkey", "l_shipdate", "l_returnflag"])


@query("""
WITH gapped AS (SELECT CASE WHEN o_orderkey % 31 > 0 THEN o_custkey % 40 END AS o_custkey,
                       o_orderdate, o_orderpriority FROM orders),
     keys AS (SELECT o_custkey, count(*) AS n FROM gapped
              GROUP BY o_custkey, o_orderdate, o_orderpriority)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicate_keys,
       CAST(sum(CASE WHEN o_custkey IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_incomplete
FROM keys
""")
def pk_report_hashed(spark, folder):
    orders = load(spark, folder, "orders").selectExpr(
        "CASE WHEN o_orderkey % 31 > 0 THEN o_custkey % 40 END AS o_custkey",
        "o_orderdate", "o_orderpriority",
    )
    return key_report_by_hash(orders, ["o_custkey", "o_orderdate", "o_orderpriority"])


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def pk_check(spark, folder):
    return duplicate_keys(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""
WITH raw AS ({shapes.DEMOGRAPHY_SQL}),
     keys AS (SELECT "City", "State", count(*) AS n FROM raw GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicate_keys,
       CAST(sum(CASE WHEN "City" IS NULL OR "State" IS NULL THEN n ELSE 0 END) AS BIGINT)
         AS n_incomplete
FROM keys
""")
def pk_report(spark, folder):
    return key_report(shapes.demography(spark, folder), ["City", "State"])


# ---------------------------------------------------------------- monthly job

# All orders as the file of one month whose codes are customers, as are the
# codes of the label text.
_RUN_MONTH = date(2016, 4, 1)
_RUN_SHAPE = shapes.ARRIVALS_PER_ORDER | {
    "i94yr": "CAST(2016 AS DOUBLE)",
    "i94mon": "CAST(4 AS DOUBLE)",
    "i94cit": "CAST(o_custkey AS DOUBLE)",
    "i94res": "CAST(o_custkey AS DOUBLE)",
    "i94port": "@text(o_custkey)",
    "i94mode": "CAST(o_custkey AS DOUBLE)",
    "i94addr": "@text(o_custkey)",
    "i94visa": "CAST(o_custkey AS DOUBLE)",
}


@contextmanager
def _month_loaded(spark: SparkSession, folder: str) -> Iterator[dict[str, DataFrame]]:
    """The tables after the monthly job has run twice on raw files."""
    base = scratch_path(spark, "run")
    orders = load(spark, folder, "orders").selectExpr(*SPARK.columns(_RUN_SHAPE))
    orders.write.parquet(f"{base}/apr16.parquet")
    write_delimited(shapes.demography(spark, folder), f"{base}/cities", sep=";")
    airport_rows = load(spark, folder, "customer").selectExpr(*SPARK.columns(AIRPORT_SHAPE))
    write_delimited(airport_rows, f"{base}/airports")
    inputs = Inputs(
        fact=f"{base}/{{}}.parquet",
        demography=f"{base}/cities",
        airports=f"{base}/airports",
        labels=_write_labels(spark, folder),
    )
    with _database(spark) as database:
        for _ in range(2):
            run_month(spark, _RUN_MONTH, inputs, database, f"{base}/stage")
        yield {
            name: warehouse.read_table(spark, table, database)
            for name, table in schemas.TABLES.items()
        }


@query(f"""{LABELS_SQL},
  ports AS ({_PORTS_SQL}),
  raw AS ({shapes.select_sql(_RUN_SHAPE, "orders")})
SELECT CAST(cicid AS BIGINT) AS cicid, c.value AS citizenship, r.value AS residence,
       p.city AS port_city, p.state AS port_state, m.value AS transportation,
       a.value AS destination, v.value AS visa_category,
       {DAY_TEXT_SQL.format("arrdate")} AS arrival_date,
       {MDY_TEXT_SQL.format("dtaddto")} AS allowedtostay_date
FROM raw
LEFT JOIN entries c ON c.block_key = 'I94CIT & I94RES' AND c.code = i94port
LEFT JOIN entries r ON r.block_key = 'I94CIT & I94RES' AND r.code = i94port
LEFT JOIN ports p ON p.code = i94port
LEFT JOIN entries m ON m.block_key = 'I94MODE' AND m.code = i94port
LEFT JOIN entries a ON a.block_key = 'I94ADDR' AND a.code = i94port
LEFT JOIN entries v ON v.block_key = 'I94VISA' AND v.code = i94port
""")
def month_run(spark, folder):
    """Raw files in, the monthly job twice, the enriched fact table out."""
    with _month_loaded(spark, folder) as tables:
        facts = star.enrich(tables[schemas.FACT.name], tables)
        result = facts.select(
            F.col("cicid").cast("bigint").alias("cicid"),
            *_ROLE_COLUMNS,
            "arrival_date",
            "allowedtostay_date",
        )
        return materialize(spark, result, "result")


def _whole_sql(measure: str) -> str:
    """A measure as the table has it; NULL beside a half, where its last bits decide."""
    near = f"abs(abs({measure} - trunc({measure})) - 0.5) < 1e-6"
    return f"CASE WHEN NOT {near} THEN CAST(round({measure}) AS BIGINT) END"


def _whole_measures_sql() -> str:
    shown = [f"coalesce(CAST({_whole_sql(c)} AS VARCHAR), '')" for c in star.MEASURES[:-1]]
    return f"concat_ws('|', {', '.join(shown)})"


@query(f"""{BY_STATE_SQL}, raw_airports AS ({shapes.select_sql(AIRPORT_SHAPE, "customer")}),
  airports AS (SELECT {_AIRPORT_SQL} FROM raw_airports)
SELECT 'city' AS kind, city AS key, state_code AS detail, race AS text, TRUE AS measures_hold,
       {_whole_measures_sql()} AS measures
FROM by_city
UNION ALL SELECT 'state', state, NULL, race, TRUE, {_whole_measures_sql()} FROM by_state
UNION ALL SELECT 'airport', ident, municipality,
  concat_ws('|', {", ".join(schemas.AIRPORT.column_names)}), NULL, NULL FROM airports
""")
def month_dimensions(spark, folder):
    """The demography and airport tables that the monthly job has loaded.

    Measures are shown as stored, but for those beside a half: there the last
    bits of a mean decide, which depend on the order of addition, and a measure
    holds if it is the mean or sum of ``by_city`` and ``by_state``, rounded.
    """
    by_city = demography_by_city(shapes.demography(spark, folder))
    by_city = materialize(spark, by_city, "city")
    measures = star.MEASURES[:-1]

    def shown(column: str) -> Column:
        exact = F.col(f"exact_{column}")
        whole = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
        beside_half = F.abs(F.abs(exact - whole) - 0.5) < 1e-6
        return F.coalesce(F.when(~beside_half, F.col(column).cast("bigint").cast("string")), F.lit(""))

    with _month_loaded(spark, folder) as tables:
        parts = []
        for kind, table, key, exact in (
            ("city", schemas.CITY_DEMOGRAPHY, "city", by_city),
            ("state", schemas.STATE_DEMOGRAPHY, "state", demography_by_state(by_city)),
        ):
            exact = _table_columns(exact, table)
            exact = exact.select(key, *[F.col(c).alias(f"exact_{c}") for c in measures])
            near = [
                F.coalesce(
                    F.abs(F.col(c).cast("double") - F.col(f"exact_{c}")) <= 0.5001,
                    F.col(c).isNull() & F.col(f"exact_{c}").isNull(),
                )
                for c in measures
            ]
            parts.append(
                tables[table.name].join(exact, key).select(
                    F.lit(kind).alias("kind"),
                    F.col(key).alias("key"),
                    (F.col("state_code") if kind == "city" else F.lit(None).cast("string")).alias("detail"),
                    F.col("race").alias("text"),
                    functools.reduce(Column.__and__, near).alias("measures_hold"),
                    F.concat_ws("|", *[shown(c) for c in measures]).alias("measures"),
                )
            )
        airports = tables[schemas.AIRPORT.name].select(
            F.lit("airport").alias("kind"),
            F.col("ident").alias("key"),
            F.col("municipality").alias("detail"),
            F.concat_ws("|", *schemas.AIRPORT.column_names).alias("text"),
            F.lit(None).cast("boolean").alias("measures_hold"),
            F.lit(None).cast("string").alias("measures"),
        )
        result = functools.reduce(DataFrame.unionByName, [*parts, airports])
        return materialize(spark, result, "result")
