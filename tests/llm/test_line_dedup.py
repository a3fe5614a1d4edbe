import duckdb
import pytest
from pyspark.sql import types as T

from landfall.llm import line_dedup
from landfall.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import FOLDER


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_matches_sql(session):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    relation = duck.sql(ORACLES["op1_line_dedup"])
    found = QUERIES["op1_line_dedup"](session, FOLDER).select(*relation.columns)
    assert rows_of(found) == sorted(relation.fetchall(), key=str)


def test_plan_has_no_python(session):
    plan = QUERIES["op1_line_dedup"](session, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if w in plan]


def test_a_sites_own_lines_go(session, docs):
    rows = [(k, f"Menu\n  text {k}\n\nMenu \r", "a") for k in range(10)]
    rows += [(k, f"Menu\ntext {k}", "b") for k in range(10, 14)]  # too few pages
    rows += [(k, "Menu" if k < 26 else f"x{k}", None) for k in range(20, 126)]  # 6 of 106
    rows += [(200, None, "a"), (201, "", "a"), (10, "Menu\ntext 10", "b")]
    cleaned = line_dedup.drop_boilerplate(docs(rows), ratio=0.05, least=5)
    assert cleaned.columns == [*docs([]).columns, "n_lines", "n_dropped"]
    found = {(r["doc_id"], r["source"]): (r["text"], r["n_lines"], r["n_dropped"]) for r in cleaned.collect()}
    assert found[3, "a"] == ("  text 3\n", 4, 2)
    # The repeated row is a page of its own, so site b has five with the line.
    assert found[10, "b"] == ("text 10", 2, 1)
    assert found[20, None] == ("", 1, 1)
    assert found[30, None] == ("x30", 1, 0)
    assert found[200, "a"] == (None, 0, 0)
    assert found[201, "a"] == ("", 1, 0)
    assert cleaned.count() == len(rows)


def test_counts_can_be_left_out(session, docs):
    rows = docs([(1, "a\nb")]).withColumnRenamed("n", "n_lines")
    cleaned = line_dedup.drop_boilerplate(rows, counts=False)
    assert cleaned.columns == rows.columns
    assert cleaned.first()["n_lines"] == 1


@pytest.mark.parametrize("size", [0, 1])
def test_tiny_tables(session, docs, size):
    cleaned = line_dedup.drop_boilerplate(docs([(1, "only")][:size]))
    assert [r["text"] for r in cleaned.collect()] == ["only"][:size]
    assert isinstance(cleaned.schema["text"].dataType, T.StringType)
