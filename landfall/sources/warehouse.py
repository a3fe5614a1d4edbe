"""Warehouse tables: create, drop, refresh dimensions, load the fact table.

All changes go through the journal: folders are written first, one record makes
them the warehouse's, and the catalog follows. See ``landfall.sources.journal``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.numbers import load_cast
from landfall.operators.star import code_counts
from landfall.schemas import FACT, LOAD_NAMES, NUMERIC, TABLES, Table
from landfall.session import delete_path, materialize, path_exists, scratch_path, shuffles_into
from landfall.sources.journal import Conflict, Journal, Month, Record


# What folders of months are called.
MONTHS = f"{FACT.name}.months"
# Rows for each of the parts that a merge deals its facts into at first.
MERGE_ROWS = 250_000


def qualified(table: Table, database: str) -> str:
    return f"`{database}`.`{table.name}`"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def create_statement(table: Table, database: str) -> str:
    """DDL with typed columns; the primary key is recorded as a property.

    Partition overwriting is dynamic by table option, whatever the session
    says: writing one month never touches another.
    """
    types = dict(table.columns)
    columns = ", ".join(f"`{c}` {_sql_type(types[c])}" for c in table.storage_order)
    partitioning = ""
    if table.partitions:
        partitioning = (
            " OPTIONS ('partitionOverwriteMode' = 'dynamic')"
            f" PARTITIONED BY ({', '.join(table.partitions)})"
        )
    return (
        f"CREATE TABLE IF NOT EXISTS {qualified(table, database)} ({columns})"
        f" USING parquet{partitioning}"
        f" TBLPROPERTIES ('primary_key' = '{','.join(table.key)}')"
    )


def _sql_type(data_type: T.DataType) -> str:
    return data_type.simpleString().upper()


def create_tables(spark: SparkSession, tables: Iterable[Table], database: str) -> None:
    for table in tables:
        spark.sql(create_statement(table, database))


def drop_tables(spark: SparkSession, tables: Iterable[Table], database: str) -> None:
    """Remove tables with their rows, from the journal first."""
    tables = list(tables)
    names = {table.name for table in tables}
    journal = Journal(spark, database)
    base = settle(spark, database, journal)
    left = replace(
        base,
        tables={n: f for n, f in base.tables.items() if n not in names},
        months={} if FACT.name in names else base.months,
    )
    if left.folders() != base.folders():
        left = journal.commit(base, left)
        journal.mark(left.generation)
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {qualified(table, database)}")
    for folder in journal.replaced(base, left):
        delete_path(spark, folder)


def read_table(spark: SparkSession, table: Table, database: str) -> DataFrame:
    """A table with its columns in declared order, as of the newest record."""
    settle(spark, database)
    return spark.table(qualified(table, database)).select(*table.column_names)


def fit_to_table(
    df: DataFrame,
    table: Table,
    names: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Columns picked by name, cast to the table's types, in storage order.

    ``columns`` limits the result to some of the table's columns. ``names`` maps
    table columns to frame columns; by default the frames of this package are
    known. Numbers round to whole ones, ties away from zero.
    """
    names = LOAD_NAMES.get(table.name, {}) if names is None else names
    types = dict(table.columns)
    columns = table.storage_order if columns is None else columns
    return df.select(
        *[
            load_cast(F.col(f"`{source}`"), df.schema[source].dataType, types[c]).alias(c)
            for c, source in ((c, names.get(c, c)) for c in columns)
        ]
    )


def location_of(spark: SparkSession, table: Table, database: str) -> str:
    """The folder that holds a table's files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(table, database)}")
    return rows.where("col_name = 'Location'").first()["data_type"]


def _point_to(spark: SparkSession, table: Table, database: str, folder: str) -> None:
    name = qualified(table, database)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def _month_of(month: tuple[int, int]) -> str:
    return f"PARTITION (i94yr = {month[0]}, i94mon = {month[1]})"


def _point_months(
    spark: SparkSession, database: str, months: Mapping[tuple[int, int], Month]
) -> None:
    """Let the fact table's months lie in these folders; others stay as they are."""
    if not months:
        return
    name = qualified(FACT, database)
    there = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = {m: v for m, v in months.items() if f"i94yr={m[0]}/i94mon={m[1]}" not in there}
    if new:
        added = " ".join(f"{_month_of(m)} LOCATION '{v.folder}'" for m, v in new.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for month, value in months.items():
        if month not in new:
            spark.sql(f"ALTER TABLE {name} {_month_of(month)} SET LOCATION '{value.folder}'")
    spark.catalog.refreshTable(name)


def _bring_up(
    spark: SparkSession,
    database: str,
    journal: Journal,
    record: Record,
    known: Record | None = None,
) -> None:
    """Let the catalog have a record, of which it has ``known`` already.

    Every step can be repeated, so a driver that is lost in between leaves work
    for the next one and nothing else.
    """
    known = known or Record()
    for name, folder in record.tables.items():
        if known.tables.get(name) != folder:
            create_tables(spark, [TABLES[name]], database)
            _point_to(spark, TABLES[name], database, folder)
    moved = {m: v for m, v in record.months.items() if known.months.get(m) != v}
    if moved:
        create_tables(spark, [FACT], database)
    _point_months(spark, database, moved)
    journal.mark(record.generation)


def settle(spark: SparkSession, database: str, journal: Journal | None = None) -> Record:
    """Bring the catalog to the newest record, if it is behind; returns that record."""
    journal = journal or Journal(spark, database)
    record = journal.newest()
    if record.generation != journal.in_catalog:
        _bring_up(spark, database, journal, record)
    return record


def recover(spark: SparkSession, database: str) -> Record:
    """What a job does first: finish or forget what an earlier one left half done.

    A change whose record is there is finished, in a catalog that knows nothing
    of the tables as well. Folders that no record names are deleted, so call it
    while no other job is writing.
    """
    journal = Journal(spark, database)
    record = settle(spark, database, journal)
    for folder in journal.orphans(record, [*TABLES, MONTHS]):
        delete_path(spark, folder)
    journal.tidy()
    return record


class Replacement:
    """New contents of dimensions and of months, written beside the old ones.

    ``stage`` and ``stage_months`` write rows to folders of their own, where a
    value that does not fit is an error; nothing has changed by then. ``switch``
    commits one record that names them all and lets the catalog follow. ``undo``
    commits what was before, ``finish`` deletes what no longer counts. Files are
    never overwritten, so a reader sees the old rows or the new ones. A process
    that is lost leaves the old tables before the commit and, once somebody
    reads them, the new ones after it.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self.journal = Journal(spark, database)
        self.folders: dict[str, str] = {}
        self.months: dict[tuple[int, int], Month] = {}
        self.staged: list[str] = []
        self.before: Record | None = None
        self.outdated: set[str] = set()

    def _new_folder(self, name: str) -> str:
        folder = self.journal.new_folder(name)
        self.staged.append(folder)
        return folder

    def stage(self, df: DataFrame, table: Table, names: Mapping[str, str] | None = None) -> None:
        """``df`` may read the table. Stages of several tables may run at once."""
        folder = self._new_folder(table.name)
        fit_to_table(df, table, names).write.parquet(folder)
        self.folders[table.name] = folder

    def stage_months(
        self,
        df: DataFrame,
        months: Sequence[tuple[int, int]],
        batches: Mapping[tuple[int, int], tuple[str, ...]] | None = None,
    ) -> None:
        """Complete contents of months, from a frame that has no row of any other.

        A month without rows stays as it is. The codes in use are counted beside
        the rows, for ``codes_by_month``.
        """
        fitted = _only_months(fit_to_table(df, FACT), months)
        folder = self._new_folder(MONTHS)
        _spread(fitted, months).write.partitionBy(*FACT.partitions).parquet(folder)
        written = {}
        for month in months:
            place = f"{folder}/i94yr={month[0]}/i94mon={month[1]}"
            if path_exists(self.spark, place):
                written[month] = Month(place, (batches or {}).get(month, ()), f"{folder}/codes")
        if written:
            stored = self.spark.read.schema(fitted.schema).parquet(folder)
            counts = code_counts(stored, also=FACT.partitions)
            counts.withColumn("folder", F.lit(folder)).write.parquet(f"{folder}/codes")
        self.months |= written

    def switch(self, base: Record | None = None) -> None:
        """Commit; on top of ``base`` alone if it is given, else of whatever is newest."""
        try:
            while True:
                before = base or settle(self.spark, self.database)
                after = replace(
                    before,
                    tables=before.tables | self.folders,
                    months=before.months | self.months,
                )
                # Folders of tables that were there before there was a journal.
                unnamed = {
                    location_of(self.spark, TABLES[n], self.database)
                    for n in self.folders
                    if n not in before.tables and self.spark.catalog.tableExists(qualified(TABLES[n], self.database))
                }
                try:
                    after = self.journal.commit(before, after)
                except Conflict:
                    if base:
                        raise
                    continue
                break
            self.before, self.outdated = before, {*self.journal.replaced(before, after), *unnamed}
            _bring_up(self.spark, self.database, self.journal, after, before)
        except BaseException:
            self.undo()
            raise

    def undo(self) -> None:
        """What was before is the newest record again; staged folders go."""
        if self.before is not None:
            before, self.before = self.before, None
            newest = self.journal.newest()
            tables = {n: f for n, f in newest.tables.items() if n not in self.folders}
            months = {m: v for m, v in newest.months.items() if m not in self.months}
            tables |= {n: f for n, f in before.tables.items() if n in self.folders}
            months |= {m: v for m, v in before.months.items() if m in self.months}
            missing_tables = [n for n in self.folders if n not in before.tables]
            missing_months = [m for m in self.months if m not in before.months]
            record = self.journal.commit(newest, replace(newest, tables=tables, months=months))
            for name in missing_tables:
                self._forget_table(TABLES[name])
            for month in missing_months:
                self.spark.sql(
                    f"ALTER TABLE {qualified(FACT, self.database)} DROP IF EXISTS {_month_of(month)}"
                )
            _bring_up(self.spark, self.database, self.journal, record)
        for folder in self.staged:
            delete_path(self.spark, folder)
        self.staged = []

    def _forget_table(self, table: Table) -> None:
        """A table that had no rows before has none again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {qualified(table, self.database)}")
        create_tables(self.spark, [table], self.database)

    def finish(self) -> None:
        """Delete the folders that were replaced, and staged ones without rows."""
        used = {f.split("/i94yr=")[0] for f in [*self.folders.values(), *(m.folder for m in self.months.values())]}
        for folder in [*self.outdated, *(f for f in self.staged if f not in used)]:
            delete_path(self.spark, folder)
        self.before, self.staged, self.outdated = None, [], set()


def refresh_dimension(
    df: DataFrame, table: Table, database: str, names: Mapping[str, str] | None = None
) -> None:
    """Replace a dimension by the latest data, or leave it as it is and fail.

    The table must exist. Its rows are written first and the table then points
    to them.
    """
    replacement = Replacement(df.sparkSession, database)
    try:
        replacement.stage(df, table, names)
        replacement.switch()
    except BaseException:
        replacement.undo()
        raise
    replacement.finish()


def _in_months(months: Sequence[tuple[int, int]]) -> Column:
    """Whether a row is of one of the months: one lookup however many they are."""
    number = F.col("i94yr") * 100 + F.col("i94mon")
    return number.cast("long").isin([y * 100 + m for y, m in months])


def _only_months(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Fail the job, while it writes, on a row of a month that was not announced.

    Overwriting by partition would let one stray row replace all of its month.
    """
    year, month = F.col("i94yr"), F.col("i94mon")
    stray = F.raise_error(
        F.concat(
            F.lit("row outside the announced months, year/month "),
            F.concat_ws("/", year.cast("string"), month.cast("string")),
        )
    )
    kept = F.when(_in_months(months), month).otherwise(stray.cast(NUMERIC))
    return df.withColumn("i94mon", kept)


def _spread(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Keep the number of files per month small, and their sizes even.

    One month is written where its rows lie. Several at once are rebalanced by
    month first, so that no task writes a file into every month; adaptive
    execution splits the months that are large and joins the small ones, so one
    month with a third of all rows is no obstacle.
    """
    return df.hint("rebalance", "i94yr", "i94mon") if len(months) > 1 else df


def load_months(
    df: DataFrame, months: Sequence[tuple[int, int]], database: str
) -> None:
    """Load complete months into the fact table; loading again changes nothing.

    The months are written to folders of their own, and the table's partitions
    switched to them all at once. A month without rows stays as it is.
    """
    replacement = Replacement(df.sparkSession, database)
    try:
        replacement.stage_months(df, months)
        replacement.switch()
    except BaseException:
        replacement.undo()
        raise
    replacement.finish()


def codes_by_month(spark: SparkSession, database: str) -> DataFrame:
    """Codes in use in each month: ``i94yr, i94mon, role, code, n_rows``.

    Counted when a month is loaded, so no facts are read, however many months.
    """
    months = settle(spark, database).months
    valid = [(m.codes.rsplit("/", 1)[0], *month) for month, m in months.items() if m.codes]
    schema = "folder string, i94yr int, i94mon int"
    current = spark.createDataFrame(valid, schema).select(
        "folder", *[F.col(c).cast(NUMERIC).alias(c) for c in FACT.partitions]
    )
    wanted = ["i94yr", "i94mon", "role", "code", "n_rows"]
    if not valid:
        empty = "i94yr decimal(18,0), i94mon decimal(18,0), role string, code string, n_rows long"
        return spark.createDataFrame([], empty)
    stored = spark.read.parquet(*sorted({f"{folder}/codes" for folder, *_ in valid}))
    return stored.join(F.broadcast(current), ["folder", *FACT.partitions]).select(*wanted)


def batch_token(df: DataFrame) -> str:
    """Names a partial file by its rows, in whatever order: their count and hashes."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    other = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in df.columns])
    sums = [F.sum(h.cast("decimal(38,0)")) for h in (row, other)]
    return "/".join(str(x or 0) for x in df.agg(F.count(F.lit(1)), *sums).first())


class PartialMerge:
    """Adds the rows of a partial file whose key the fact table lacks.

    A month is merged by copy: ``stage`` writes its stored rows and the new ones
    to a folder of their own, and ``commit`` switches the partition to it, if the
    table is still what it was then. A month remembers the files that went into
    it, by their ``batch``, until it is loaded as a whole.
    """

    def __init__(
        self,
        df: DataFrame,
        months: Sequence[tuple[int, int]],
        database: str,
        batch: str | None = None,
    ):
        self.spark, self.months, self.database = df.sparkSession, months, database
        fitted = _only_months(fit_to_table(df, FACT), months)
        self.scratch = scratch_path(self.spark, "partial")
        self.given = materialize(self.spark, fitted, "given", self.scratch)
        self.batch = batch or batch_token(self.given)
        self.base: Record | None = None
        self.replacement: Replacement | None = None

    def stage(self) -> bool:
        """Write the merged months; false if the file has been merged before."""
        self.base = settle(self.spark, self.database)
        known = self.base.months
        if any(self.batch in known[m].batches for m in self.months if m in known):
            return False
        present = {(int(r[0]), int(r[1])) for r in self.given.select(*FACT.partitions).distinct().collect()}
        touched = [m for m in self.months if m in present]
        self.replacement = Replacement(self.spark, self.database)
        if touched:
            name = qualified(FACT, self.database)
            stored = self.spark.table(name).filter(_in_months(touched)).select(*FACT.storage_order)
            new = self.new_rows(stored).select(*FACT.storage_order)
            parts = 1 + (self.given.count() + stored.count()) // MERGE_ROWS
            before = {m: known[m].batches if m in known else () for m in touched}
            batches = {m: (*b, self.batch) for m, b in before.items()}
            try:
                with shuffles_into(self.spark, parts):
                    self.replacement.stage_months(stored.unionByName(new), touched, batches)
            except BaseException:
                self.replacement.undo()
                raise
        return True

    def new_rows(self, stored: DataFrame) -> DataFrame:
        """The given rows whose key no stored row has.

        Stored keys are as many as the rows, though their files are small enough
        to look like a table to broadcast: both sides are shuffled.
        """
        keys = stored.select(*[F.col(c).alias(f"stored_{c}") for c in FACT.key])
        same = [F.col(c).eqNullSafe(F.col(f"stored_{c}")) for c in FACT.key]
        return self.given.join(keys.hint("merge"), same, "left_anti")

    def commit(self) -> bool | None:
        """Switch to the merged months; None if another writer came first."""
        try:
            self.replacement.switch(self.base)
        except Conflict:
            return None
        self.replacement.finish()
        return True

    def run(self) -> bool:
        """Stage and commit until one of them settles it; whether it was merged."""
        try:
            while self.stage():
                if self.commit():
                    return True
            return False
        finally:
            delete_path(self.spark, self.scratch)


def append_new_rows(
    df: DataFrame, months: Sequence[tuple[int, int]], database: str, batch: str | None = None
) -> bool:
    """Add the rows of a partial file whose key the fact table lacks.

    ``batch`` names the file, by default after its rows. A file that comes again,
    after a lost answer or from a second writer at the same time, is refused: the
    result tells whether it was merged. Of two writers with different files the
    later one merges again, on top of the first one's rows.

    Only the announced months are read. A missing part of a key equals a missing
    one. Rows that repeat a new key within the file are all added; the key check
    tells.
    """
    return PartialMerge(df, months, database, batch).run()
