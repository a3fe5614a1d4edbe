"""Star joins, checked broadcasts and reference checks."""

import pytest
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators import star
from landfall.operators.joins import attach, attach_many, measured_bytes, sized_broadcast


@pytest.fixture
def tables(spark):
    def make(table, rows):
        columns = ", ".join(f"{c} {t.simpleString()}" for c, t in table.columns)
        text = ", ".join(f"{c} string" for c in table.column_names)
        frame = spark.createDataFrame(rows, text)
        return frame.selectExpr(*[f"CAST({p.rsplit(' ', 1)[0]} AS {p.rsplit(' ', 1)[1]})"
                                  f" AS {p.rsplit(' ', 1)[0]}" for p in columns.split(", ")])  # fmt: skip

    return {
        t.name: make(t, rows)
        for t, rows in {
            schemas.COUNTRY: [("101", "ALBANIA"), ("102", "ANDORRA"), ("103", "ALBANIA")],
            schemas.ADDRESS: [("AK", "ALASKA"), ("OH", "OHIO")],
            schemas.PORT: [("ALC", "AK", "ALCAN"), ("ANC", "AK", "Anchorage")],
            schemas.MODE: [("1", "AIR"), ("2", "SEA")],
            schemas.VISA: [("1", "BUSINESS"), ("2", "PLEASURE")],
        }.items()
    }


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [
            (1, 101, 102, "ALC", 1, "AK", 1),
            (2, 103, 101, "ALC", 2, "OH", 2),
            (3, 101, 999, "XXX", 9, None, 2),
            (4, None, 101, "ANC", 1, "AK", 2),
        ],
        "cicid int, i94cit int, i94res int, i94port string, i94mode int,"
        " i94addr string, i94visa int",
    )


def test_enrich_keeps_every_fact(facts, tables):
    rows = {r.cicid: r for r in star.enrich(facts, tables).collect()}
    assert len(rows) == 4
    assert (rows[1].citizenship, rows[1].residence) == ("ALBANIA", "ANDORRA")
    assert (rows[1].port_city, rows[1].port_state) == ("ALCAN", "AK")
    assert (rows[2].transportation, rows[2].destination) == ("SEA", "OHIO")
    assert rows[2].visa_category == "PLEASURE"
    assert rows[3].residence is None and rows[3].port_city is None
    assert rows[4].citizenship is None


def test_counts_merge_codes_with_one_label(facts, tables):
    rows = star.arrivals_by(facts, tables, ["citizenship"]).collect()
    assert {r.citizenship: r.arrivals for r in rows} == {"ALBANIA": 3, None: 1}


def test_unmatched_codes(facts, tables):
    rows = {tuple(r) for r in star.unmatched_codes(facts, tables).collect()}
    assert rows == {("residence", "999", 1), ("port", "XXX", 1), ("mode", "9", 1)}


def test_airport_fan_out_ignores_case_and_keeps_ports(spark, tables):
    airports = spark.createDataFrame(
        [("A1", "small", "One", "ANCHORAGE", "X"), ("A2", "large", "Two", "anchorage", None)],
        "ident string, airport_type string, name string, municipality string,"
        " iata_code string",
    )
    rows = star.ports_with_airports(tables[schemas.PORT.name], airports).collect()
    assert sorted((r.i94port_code, r.airport_ident or "") for r in rows) == [
        ("ALC", ""), ("ANC", "A1"), ("ANC", "A2"),
    ]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_attach_many_equals_left_join(spark, limit):
    """Either side of the size limit; a third of the right rows on one key."""
    left = spark.createDataFrame([(i, f"n{i}") for i in [*range(20), None]], "a int, n string")
    right = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 15).alias("b"),
        "id",
    )
    ours = attach_many(left, right, {"a": "b"}, limit).select("a", "n", "b", "id")
    plain = left.join(right, F.col("a") == F.col("b"), "left").select("a", "n", "b", "id")
    key = repr
    assert sorted(ours.collect(), key=key) == sorted(plain.collect(), key=key)


def test_broadcast_only_within_the_limit(spark):
    small = spark.range(1000).selectExpr("id AS k", "cast(id AS string) AS s")
    big = spark.range(100000).selectExpr("id % 1000 AS f")
    assert 1000 * 16 < measured_bytes(small) < 1000 * 200

    def plan(limit):
        joined = attach(big, sized_broadcast(small, limit), {"f": "k"}, {"s": "s"})
        return joined._jdf.queryExecution().sparkPlan().toString()

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(1 << 20)
        assert "SortMergeJoin" in plan(100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_snowflake_hops(spark, tables):
    measures = [("OHIO", *[str(i) for i in range(8)], "White")]
    columns = "state string, " + ", ".join(f"{c} string" for c in star.MEASURES)
    demography = spark.createDataFrame(measures, columns)
    rows = star.states_with_demography(tables[schemas.ADDRESS.name], demography).collect()
    assert {r.i94addr_code: r.state_race for r in rows} == {"AK": None, "OH": "White"}
    cities = demography.withColumnRenamed("state", "city").withColumn("city", F.lit("ALCAN"))
    rows = star.ports_with_demography(tables[schemas.PORT.name], cities).collect()
    assert {r.i94port_code: r.city_count for r in rows} == {"ALC": "7", "ANC": None}


def test_codes_are_counted_before_they_become_text(spark):
    """Numbers and texts side by side; no code is turned into text for every row."""
    facts = spark.range(30).selectExpr(
        "CAST(id % 3 AS DECIMAL(18, 0)) AS i94cit",
        "CASE WHEN id % 2 = 0 THEN CAST(id % 3 AS STRING) END AS i94port",
    )
    counts = star.code_counts(facts, ("citizenship", "port"))
    assert sorted(tuple(r) for r in counts.collect()) == [
        ("citizenship", "0", 10), ("citizenship", "1", 10), ("citizenship", "2", 10),
        ("port", "0", 5), ("port", "1", 5), ("port", "2", 5),
    ]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "number" in grouped and "text" in grouped
    empty = star.code_counts(facts.where("i94cit < 0"), ("citizenship", "port"))
    assert empty.columns == ["role", "code", "n_rows"] and empty.count() == 0
