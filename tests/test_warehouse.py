"""Tables: DDL, casts, refresh, month loads and key checks."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators.quality import (
    duplicate_keys,
    incomplete_keys,
    key_report,
    load_report,
)
from landfall.sources import warehouse
from landfall.sources.readers import read_headerless
from landfall.sources.writers import write_month


@pytest.fixture
def database(spark, tmp_path):
    name = f"w{uuid.uuid4().hex[:8]}"
    warehouse.create_database(spark, name, str(tmp_path / name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def fact_rows(spark, months, offset=0):
    """Fact-shaped frame: ``months`` maps (year, month) to a number of rows."""
    rows = [
        (float(offset + i), float(y), float(m), 92478761130.0 + i, f"F{i}")
        for (y, m), n in months.items()
        for i in range(n)
    ]
    frame = spark.createDataFrame(
        rows, "cicid double, i94yr double, i94mon double, admnum double, fltno string"
    )
    return frame.select(
        *[
            F.col(c) if c in frame.columns
            else F.lit(None).cast("double" if t == schemas.NUMERIC else "string").alias(c)
            for c, t in schemas.FACT.columns
        ]
    )


def month_counts(spark, database):
    facts = warehouse.read_table(spark, schemas.FACT, database)
    return {
        (int(r.i94yr), int(r.i94mon)): r["count"]
        for r in facts.groupBy("i94yr", "i94mon").count().collect()
    }


def test_tables_have_the_declared_columns(spark, database):
    warehouse.create_tables(spark, schemas.TABLES.values(), database)
    for table in schemas.TABLES.values():
        frame = warehouse.read_table(spark, table, database)
        assert frame.columns == table.column_names
        properties = spark.sql(f"SHOW TBLPROPERTIES {database}.{table.name}").collect()
        assert {r.key: r.value for r in properties}["primary_key"] == ",".join(table.key)
        for row in spark.sql(f"DESCRIBE {database}.{table.name}").collect():
            expected = dict(table.columns).get(row.col_name)
            if expected is not None:
                assert row.data_type == expected.simpleString()
    assert len(schemas.FACT_COLUMNS) == 25 and len(schemas.TABLES) == 9


def test_create_again_keeps_and_drop_removes(spark, database):
    table = schemas.MODE
    warehouse.create_tables(spark, [table], database)
    modes = spark.createDataFrame([("1", "AIR")], "I94mode_Code string, Transportation string")
    warehouse.refresh_dimension(modes, table, database)
    warehouse.create_tables(spark, [table], database)
    assert warehouse.read_table(spark, table, database).count() == 1
    warehouse.drop_tables(spark, [table, schemas.FACT], database)
    assert not spark.catalog.tableExists(f"{database}.{table.name}")


def test_refresh_keeps_the_latest_only_and_loads_by_name(spark, database):
    warehouse.create_tables(spark, [schemas.PORT], database)
    columns = "I94port_Code string, City string, State string"
    for city in ("OLD", "ALCAN"):
        frame = spark.createDataFrame([("ALC", city, "AK")], columns)
        warehouse.refresh_dimension(frame, schemas.PORT, database)
    row = warehouse.read_table(spark, schemas.PORT, database).collect()
    assert [r.asDict() for r in row] == [
        {"i94port_code": "ALC", "state": "AK", "city": "ALCAN"}
    ]


def test_decimals_round_half_away_from_zero(spark, database):
    frame = spark.createDataFrame([(2.65,), (2.5,), (-0.5,), (2.4,)], "x double")
    rounded = frame.select(F.col("x").cast(schemas.NUMERIC).alias("x")).collect()
    assert [r.x for r in rounded] == [Decimal(3), Decimal(3), Decimal(-1), Decimal(2)]


def test_overlong_text_and_bad_numbers_fail(spark, database):
    warehouse.create_tables(spark, [schemas.MODE, schemas.ADDRESS], database)
    columns = "I94addr_Code string, State string"
    fits = spark.createDataFrame([("AL", "x" * 256)], columns)
    warehouse.refresh_dimension(fits, schemas.ADDRESS, database)
    over = spark.createDataFrame([("AL", "x" * 257)], columns)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.refresh_dimension(over, schemas.ADDRESS, database)
    bad = spark.createDataFrame([("one", "AIR")], "I94mode_Code string, Transportation string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        warehouse.refresh_dimension(bad, schemas.MODE, database)


def test_loading_a_month_again_changes_nothing(spark, database):
    warehouse.create_tables(spark, [schemas.FACT], database)
    for month, n in (((2019, 9), 10), ((2019, 10), 7), ((2019, 10), 7), ((2019, 9), 10)):
        warehouse.load_months(fact_rows(spark, {month: n}), [month], database)
    assert month_counts(spark, database) == {(2019, 9): 10, (2019, 10): 7}


def test_dynamic_overwrite_holds_whatever_the_session_says(spark, database):
    warehouse.create_tables(spark, [schemas.FACT], database)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        warehouse.load_months(fact_rows(spark, {(2019, 9): 3}), [(2019, 9)], database)
        warehouse.load_months(fact_rows(spark, {(2019, 10): 2}), [(2019, 10)], database)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert month_counts(spark, database) == {(2019, 9): 3, (2019, 10): 2}


def test_a_stray_month_stops_the_load_and_nothing_changes(spark, database):
    warehouse.create_tables(spark, [schemas.FACT], database)
    both = {(2019, 8): 5, (2019, 9): 5}
    warehouse.load_months(fact_rows(spark, both), list(both), database)
    stray = fact_rows(spark, {(2019, 9): 6, (2019, 8): 1})
    with pytest.raises(Exception, match="announced months"):
        warehouse.load_months(stray, [(2019, 9)], database)
    undated = fact_rows(spark, {(2019, 9): 6}).withColumn("i94mon", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="announced months"):
        warehouse.load_months(undated, [(2019, 9)], database)
    assert month_counts(spark, database) == both


def test_partial_files_add_only_new_rows(spark, database):
    warehouse.create_tables(spark, [schemas.FACT], database)
    month = (2019, 9)
    warehouse.load_months(fact_rows(spark, {month: 5}), [month], database)
    for _ in range(2):
        warehouse.append_new_rows(fact_rows(spark, {month: 8}), [month], database)
    assert month_counts(spark, database) == {month: 8}


def test_missing_keys_and_repeats_are_added_once(spark, database):
    warehouse.create_tables(spark, [schemas.FACT], database)
    month = (2019, 9)
    rows = fact_rows(spark, {month: 4})
    gap = rows.withColumn("cicid", F.when(F.col("cicid") > 1, F.col("cicid")))
    gap = gap.unionByName(rows.where("cicid = 3"))
    for _ in range(3):
        warehouse.append_new_rows(gap, [month], database)
    stored = warehouse.read_table(spark, schemas.FACT, database).select("cicid").collect()
    assert sorted((r[0] is None, r[0] or 0) for r in stored) == [
        (False, 2), (False, 3), (False, 3), (True, 0), (True, 0),
    ]


def test_a_failed_refresh_keeps_the_old_rows(spark, database, tmp_path):
    warehouse.create_tables(spark, [schemas.ADDRESS], database)
    columns = "I94addr_Code string, State string"
    fits = spark.createDataFrame([("AL", "ALABAMA")], columns)
    warehouse.refresh_dimension(fits, schemas.ADDRESS, database)
    folders = sorted((tmp_path / database).iterdir())
    over = spark.createDataFrame([("AL", "ok"), ("AK", "x" * 257)], columns)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.refresh_dimension(over, schemas.ADDRESS, database)
    table = warehouse.read_table(spark, schemas.ADDRESS, database)
    assert [r.state for r in table.collect()] == ["ALABAMA"]
    assert sorted((tmp_path / database).iterdir()) == folders


def test_load_report_counts_misfits(spark):
    frame = spark.createDataFrame(
        [("1", "AIR"), ("x", "y" * 300), (None, None)], "I94mode_Code string, Transportation string"
    )
    rows = {r["column"]: tuple(r)[1:] for r in load_report(frame, schemas.MODE).collect()}
    assert rows == {"i94mode_code": (3, 1, 1), "transportation": (3, 1, 1)}


def files_per_month(folder):
    counts = {}
    for file in folder.rglob("i94mon=*/part-*.parquet"):
        counts[file.parent] = counts.get(file.parent, 0) + 1
    return counts


def test_many_months_with_a_hot_one(spark, database, tmp_path):
    """Several tasks write the hot month; others share at most their hash bucket's."""
    warehouse.create_tables(spark, [schemas.FACT], database)
    months = {(2018, m): 50 for m in range(1, 13)} | {(2019, 1): 6000}
    facts = fact_rows(spark, months).repartition(16)
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        warehouse.load_months(facts, list(months), database)
        loaded = files_per_month(tmp_path / database)
        warehouse.append_new_rows(facts, list(months), database)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert month_counts(spark, database) == months
    assert len(loaded) == len(months)
    *usual, hot = sorted(loaded.values())
    assert hot > 1
    assert usual.count(1) > len(usual) / 2


def test_appending_to_many_months_makes_few_files(spark, database, tmp_path):
    warehouse.create_tables(spark, [schemas.FACT], database)
    months = {(2018, m): 50 for m in range(1, 13)}
    for _ in range(2):
        warehouse.append_new_rows(fact_rows(spark, months).repartition(16), list(months), database)
    assert month_counts(spark, database) == months
    assert set(files_per_month(tmp_path / database).values()) == {1}


def test_csv_month_keeps_digits(spark, tmp_path):
    facts = fact_rows(spark, {(2019, 9): 4}).repartition(2)
    path = write_month(facts, str(tmp_path), "sep19", format="csv")
    text = "".join(f.read_text() for f in (tmp_path / "sep19").glob("part-*"))
    assert path.endswith("/sep19")
    assert "92478761131" in text and "E10" not in text
    assert text.count("\n") == 4
    schema = schemas.T.StructType(
        [
            schemas.T.StructField(c, t if t == schemas.NUMERIC else schemas.T.StringType())
            for c, t in schemas.FACT.columns
        ]
    )
    rows = read_headerless(spark, path, schema).select("admnum").collect()
    assert {int(r.admnum) for r in rows} == {92478761130 + i for i in range(4)}


def test_month_write_modes(spark, tmp_path):
    facts = fact_rows(spark, {(2019, 9): 2})
    write_month(facts, str(tmp_path), "sep19")
    write_month(facts, str(tmp_path), "sep19")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_month(facts, str(tmp_path), "sep19", mode="error")
    assert spark.read.parquet(str(tmp_path / "sep19")).count() == 2


def test_key_checks(spark):
    frame = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, None)], "k int, l string"
    )
    assert [tuple(r) for r in duplicate_keys(frame, ["k", "l"]).collect()] == [(1, "a", 2)]
    assert tuple(incomplete_keys(frame, ["k", "l"]).first()) == (2, 1)
    assert key_report(frame, ["k", "l"]).first().asDict() == {
        "n_rows": 5, "n_keys": 4, "n_duplicate_keys": 1, "n_incomplete": 2,
    }
    assert key_report(frame.limit(0), ["k"]).first()["n_rows"] == 0


def test_merge_shuffles_the_stored_keys(spark, database):
    """However small their files look, stored keys are as many as the stored rows."""
    month = (2016, 4)
    warehouse.create_tables(spark, [schemas.FACT], database)
    warehouse.load_months(fact_rows(spark, {month: 6}), [month], database)
    merge = warehouse.PartialMerge(fact_rows(spark, {month: 9}), [month], database)
    stored = spark.table(warehouse.qualified(schemas.FACT, database)).select(*schemas.FACT.storage_order)
    new = merge.new_rows(stored)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(int(r["cicid"]) for r in new.collect()) == [6, 7, 8]
    assert merge.run()


def test_merge_deals_rows_into_parts_by_their_number(spark, database, monkeypatch):
    month = (2016, 4)
    warehouse.create_tables(spark, [schemas.FACT], database)
    warehouse.load_months(fact_rows(spark, {month: 40}), [month], database)
    monkeypatch.setattr(warehouse, "MERGE_ROWS", 4)
    seen, name = [], "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    stage = warehouse.Replacement.stage_months

    def noted(self, *arguments):
        seen.append(spark.conf.get(name, None))
        stage(self, *arguments)

    monkeypatch.setattr(warehouse.Replacement, "stage_months", noted)
    assert warehouse.append_new_rows(fact_rows(spark, {month: 60}), [month], database)
    assert seen == ["26"] and spark.conf.get(name, None) is None
    assert warehouse.read_table(spark, schemas.FACT, database).count() == 60
