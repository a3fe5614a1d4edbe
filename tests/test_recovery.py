"""A warehouse after a lost driver, in a new process whose catalog knows nothing."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from landfall import schemas
from landfall.sources import warehouse
from landfall.sources.journal import Conflict, Journal, Month, Record
from tests.test_labels import TEXT
from tests.test_month import AIRPORTS, DEMOGRAPHY, write_fact
from tests.test_warehouse import database, fact_rows, month_counts  # noqa: F401

ROOT = Path(__file__).resolve().parents[1]


def contents(spark, name):
    return {
        table.name: sorted(map(str, warehouse.read_table(spark, table, name).collect()))
        for table in schemas.TABLES.values()
    }


def run_elsewhere(folder, name, step="none", after=0, partial=False, fact="i94"):
    """The monthly job in a process of its own; whether it came to its end."""
    given = {
        "home": f"{folder}/wh",
        "scratch": f"{folder}/scratch",
        "stage": f"{folder}/stage",
        "database": name,
        "step": step,
        "after": after,
        "partial": partial,
        "month": [2019, 9, 1],
        "inputs": {
            "fact": f"{folder}/{fact}_{{}}.parquet",
            "demography": f"{folder}/cities.csv",
            "airports": f"{folder}/airports.csv",
            "labels": f"{folder}/labels.txt",
            "airport_headers": {"airport_type": "type"},
        },
    }
    environment = {**os.environ, "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, str(ROOT / "tests" / "lost_driver.py"), json.dumps(given)],
        env=environment, capture_output=True, timeout=600, cwd=folder,
    )
    assert done.returncode in (0, 17), done.stderr.decode()[-3000:]
    return done.returncode == 0


def reopened(spark, folder, name):
    """The contents as a catalog sees them that has just been told of the folder."""
    fresh = f"again_{name}_{os.urandom(3).hex()}"
    warehouse.create_database(spark, fresh, f"{folder}/wh")
    warehouse.recover(spark, fresh)
    found = contents(spark, fresh)
    home = {p.name for p in (folder / "wh").iterdir() if "-" in p.name}
    named = Journal(spark, fresh).newest().folders()
    assert all(any(f"/{n}" in f for f in named) for n in home)
    # The database stays: dropping it would delete the rows, which others open again.
    return found


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A folder with raw files, a month loaded by one process, and new raw files."""
    folder = tmp_path_factory.mktemp("lost")
    (folder / "labels.txt").write_text(TEXT)
    (folder / "airports.csv").write_text(AIRPORTS)
    (folder / "cities.csv").write_text(DEMOGRAPHY)
    write_fact(spark, folder, "sep19", 2019, 9, 20)
    assert run_elsewhere(folder, "lost")
    return folder


# A run first brings its empty catalog up: eight tables, one month, a mark. Then
# it switches: one commit, and the same again. Step, calls before the end, and
# whether the new tables hold.
STEPS = [
    ("_point_to", 3, False),
    ("commit", 0, False),
    ("_point_to", 8, True),
    ("_point_to", 12, True),
    ("_point_to", 15, True),
    ("_point_months", 1, True),
    ("mark", 1, True),
]


def test_a_driver_lost_at_any_step_leaves_nine_old_or_nine_new_tables(spark, loaded):
    before = reopened(spark, loaded, "lost")
    assert len(before["I94Immigration_form"]) == 20 and all(before.values())
    for n, (step, after, new) in enumerate(STEPS):
        (loaded / "labels.txt").write_text(TEXT.replace("Albania", f"Elsewhere {n}"))
        (loaded / "cities.csv").write_text(DEMOGRAPHY.replace("White", f"Green {n}"))
        write_fact(spark, loaded / f"n{n}", "sep19", 2019, 9, 21 + n)
        assert not run_elsewhere(loaded, "lost", step, after, fact=f"n{n}/i94")
        found = reopened(spark, loaded, "lost")
        if not new:
            assert found == before
        else:
            assert len(found["I94Immigration_form"]) == 21 + n
            assert f"ELSEWHERE {n}" in str(found["I94CIT_I94RES_Code"]).upper()
            assert f"Green {n}" in str(found["US_Demography_by_City"])
        before = found
    assert run_elsewhere(loaded, "lost")
    assert len(reopened(spark, loaded, "lost")["I94Immigration_form"]) == 20


def test_a_commit_that_fails_keeps_the_old_month(spark, database, monkeypatch):  # noqa: F811
    warehouse.create_tables(spark, [schemas.FACT], database)
    months = {(2019, 9): 5, (2019, 10): 4}
    warehouse.load_months(fact_rows(spark, months), list(months), database)
    before = contents_of_facts(spark, database)
    for failing in ("commit", "mark"):
        with monkeypatch.context() as patch:
            broken = dict(left=1)
            real = getattr(Journal, failing)

            def once(self, *args, real=real, broken=broken):
                if broken.pop("left", None):
                    raise OSError("no storage")
                return real(self, *args)

            patch.setattr(Journal, failing, once)
            with pytest.raises(OSError, match="no storage"):
                warehouse.load_months(fact_rows(spark, {(2019, 9): 7}), [(2019, 9)], database)
        assert contents_of_facts(spark, database) == before
    assert warehouse.Journal(spark, database).orphans(Journal(spark, database).newest(), [warehouse.MONTHS]) == []
    warehouse.load_months(fact_rows(spark, {(2019, 9): 7}), [(2019, 9)], database)
    assert month_counts(spark, database) == {(2019, 9): 7, (2019, 10): 4}


def contents_of_facts(spark, name):
    return sorted(map(str, warehouse.read_table(spark, schemas.FACT, name).collect()))


def test_two_writers_of_one_partial_file_leave_one_copy(spark, database, monkeypatch):  # noqa: F811
    warehouse.create_tables(spark, [schemas.FACT], database)
    month = (2019, 9)
    warehouse.load_months(fact_rows(spark, {month: 3}), [month], database)
    given, answers = fact_rows(spark, {month: 8}), []
    real = Journal.commit

    def overtaken(self, base, change):
        """Before the first writer commits, the second one does it all."""
        monkeypatch.setattr(Journal, "commit", real)
        answers.append(warehouse.append_new_rows(given.repartition(5), [month], database))
        return real(self, base, change)

    monkeypatch.setattr(Journal, "commit", overtaken)
    answers.append(warehouse.append_new_rows(given, [month], database))
    assert answers == [True, False]
    assert month_counts(spark, database) == {month: 8}


def test_two_writers_of_different_partial_files_both_count(spark, database, monkeypatch):  # noqa: F811
    warehouse.create_tables(spark, [schemas.FACT], database)
    month = (2019, 9)
    real = Journal.commit

    def overtaken(self, base, change):
        monkeypatch.setattr(Journal, "commit", real)
        assert warehouse.append_new_rows(fact_rows(spark, {month: 6}, offset=4), [month], database)
        return real(self, base, change)

    monkeypatch.setattr(Journal, "commit", overtaken)
    assert warehouse.append_new_rows(fact_rows(spark, {month: 5}), [month], database)
    assert month_counts(spark, database) == {month: 10}


def test_a_batch_comes_again_until_the_month_is_loaded_anew(spark, database):  # noqa: F811
    warehouse.create_tables(spark, [schemas.FACT], database)
    month = (2019, 9)
    given = fact_rows(spark, {month: 4})
    assert warehouse.append_new_rows(given, [month], database, batch="file-1")
    assert not warehouse.append_new_rows(fact_rows(spark, {month: 9}), [month], database, batch="file-1")
    warehouse.load_months(fact_rows(spark, {month: 2}), [month], database)
    assert warehouse.append_new_rows(given, [month], database, batch="file-1")
    assert month_counts(spark, database) == {month: 4}


def test_records_read_as_written_and_numbers_are_taken_once(spark, database):  # noqa: F811
    journal = Journal(spark, database)
    assert journal.newest() == Record()
    record = Record(0, {"T": "a/ü b"}, {(2019, 9): Month("x", ("1", "2")), (2018, 12): Month("y")})
    first = journal.commit(Record(), record)
    assert first.generation == 1 and journal.newest() == first
    with pytest.raises(Conflict):
        journal.commit(Record(), record)
    for _ in range(25):
        first = journal.commit(first, record)
    journal.tidy()
    assert journal.newest() == first
    assert len(journal._names(journal.folder)) == 20


def test_dropped_tables_stay_dropped(spark, database):  # noqa: F811
    warehouse.create_tables(spark, [schemas.FACT], database)
    warehouse.load_months(fact_rows(spark, {(2019, 9): 3}), [(2019, 9)], database)
    warehouse.drop_tables(spark, [schemas.FACT], database)
    warehouse.recover(spark, database)
    assert not spark.catalog.tableExists(f"{database}.{schemas.FACT.name}")
    warehouse.create_tables(spark, [schemas.FACT], database)
    assert month_counts(spark, database) == {}
