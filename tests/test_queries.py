"""Every registered query on the given tables: its plan, and its SQL's rows."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from landfall.plans.driver_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(
    not Path(FOLDER).exists(), reason="the given tables are absent"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(canonical(row[i]) for i in order) for row in rows), key=repr
    )


# No Python worker on the executors, no join without an equality.
UNWANTED = ("Python", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(relation.columns)
    ours = rows_of(result.columns, result.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:5]


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
