"""The monthly job: clean everything, check it, then change the warehouse."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators.airport import clean_airport
from landfall.operators.demography import (
    RACE_SEPARATOR,
    demography_by_city,
    demography_by_state,
)
from landfall.operators.fact import clean_fact
from landfall.operators.labels import BLOCKS, label_tables, parse_labels
from landfall.operators.quality import key_report, load_report
from landfall.operators.star import ROLES, codes_without_table
from landfall.session import materialize, scratch_folder
from landfall.sources.readers import (
    read_airports,
    read_demography,
    read_lines,
    read_month,
    scan_fact,
)
from landfall.sources.warehouse import (
    Replacement,
    append_new_rows,
    codes_by_month,
    create_tables,
    fit_to_table,
    read_table,
    recover,
)
from landfall.sources.writers import write_delimited, write_month


@dataclass(frozen=True)
class Inputs:
    """Where the raw files are and how they are read.

    ``fact`` is a path with a ``{}`` for the tag. ``multiline`` is for delimited
    files whose quoted fields contain line breaks, the month staged as text too.
    ``fact_renames`` maps expected columns of the fact file to the file's names.
    """

    fact: str
    demography: str
    airports: str
    labels: str
    fact_format: str = "parquet"
    fact_options: Mapping[str, str] = field(default_factory=dict)
    fact_renames: Mapping[str, str] = field(default_factory=dict)
    airport_headers: Mapping[str, str] = field(default_factory=dict)
    multiline: bool = False
    legacy_na: bool = False


@dataclass(frozen=True)
class Rules:
    """Choices of the cleaning and of the load.

    ``partial`` adds the rows of a partial file instead of replacing the month;
    ``batch`` names the file, by default after its rows.
    ``stage_format`` may be ``csv``, which is then loaded from that text.
    """

    typed_dates: bool = False
    city_keys: Sequence[str] = ("City",)
    glue: str = RACE_SEPARATOR
    stage_format: str = "parquet"
    partial: bool = False
    batch: str | None = None
    strict_keys: bool = False


class KeyViolation(ValueError):
    """A cleaned table breaks its primary key."""


class LoadViolation(ValueError):
    """A cleaned table holds values that its columns refuse."""


def tag_of(month: datetime.date) -> str:
    """Month tag such as ``sep19``, independent of the locale."""
    names = "jan feb mar apr may jun jul aug sep oct nov dec".split()
    return f"{names[month.month - 1]}{month.year % 100:02d}"


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run independent steps at the same time; their results in order.

    Each submits its own Spark jobs, so small ones fill the gaps of others. The
    first failure is raised after all have ended.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def clean_dimensions(
    spark: SparkSession, inputs: Inputs, rules: Rules, folder: str
) -> dict[str, DataFrame]:
    """The eight dimension frames, by table name, from stages in a folder."""

    def demography() -> tuple[DataFrame, DataFrame]:
        raw = read_demography(spark, inputs.demography, inputs.multiline)
        city = demography_by_city(raw, tuple(rules.city_keys))
        city = materialize(spark, city, "city", folder)
        return city, materialize(spark, demography_by_state(city, rules.glue), "state", folder)

    def labels() -> dict[str, DataFrame]:
        entries = parse_labels(read_lines(spark, inputs.labels), folder)
        return label_tables(materialize(spark, entries, "labels", folder))

    def airports() -> DataFrame:
        raw = read_airports(
            spark, inputs.airports, inputs.airport_headers, inputs.legacy_na, inputs.multiline
        )
        return materialize(spark, clean_airport(raw), "airport", folder)

    (city, state), tables, airport = together(spark, demography, labels, airports)
    return {
        schemas.CITY_DEMOGRAPHY.name: city,
        schemas.STATE_DEMOGRAPHY.name: state,
        schemas.AIRPORT.name: airport,
        **tables,
    }


def check_values(frames: Mapping[str, DataFrame]) -> None:
    """Stop if a frame holds values that its table refuses; all in a single job."""
    reports = [
        load_report(frame, schemas.TABLES[name]).select(F.lit(name).alias("table"), "*")
        for name, frame in frames.items()
    ]
    combined = functools.reduce(DataFrame.unionByName, reports)
    bad = combined.where("n_misfit > 0").orderBy("table", "column").collect()
    if bad:
        named = ", ".join(f"{r['table']}.{r['column']} ({r['n_misfit']})" for r in bad)
        raise LoadViolation(f"values that do not fit: {named}")


def check_keys(frames: Mapping[str, DataFrame]) -> dict[str, dict[str, int]]:
    """The key report of every frame, as it would be loaded, in a single job."""
    reports = []
    for name, frame in frames.items():
        table = schemas.TABLES[name]
        report = key_report(fit_to_table(frame, table, columns=table.key), table.key)
        reports.append(report.select(F.lit(name).alias("table"), "*"))
    combined = functools.reduce(DataFrame.unionByName, reports)
    rows = [row.asDict() for row in combined.collect()]
    return {row.pop("table"): row for row in rows}


# Tables whose codes the facts join: two values for a code would double facts.
CODE_TABLES = frozenset(table for table, _ in BLOCKS.values())


def broken_keys(reports: Mapping[str, Mapping[str, int]], strict: bool) -> list[str]:
    """Tables whose broken key stops the load: code tables, or all if ``strict``."""
    return sorted(
        name
        for name, report in reports.items()
        if (strict and (report["n_duplicate_keys"] or report["n_incomplete"]))
        or (name in CODE_TABLES and report["n_duplicate_keys"])
    )


def unmatched_in(spark: SparkSession, database: str, month: datetime.date) -> dict[str, int]:
    """For each role, how many of a loaded month's codes its table lacks.

    Read from the counts that are kept with the month, not from its facts.
    """
    counts = codes_by_month(spark, database).where(
        (F.col("i94yr") == month.year) & (F.col("i94mon") == month.month)
    )
    names = {role.table for role in ROLES.values()}
    tables = {n: read_table(spark, schemas.TABLES[n], database) for n in names}
    lacking = codes_without_table(counts, tables).groupBy("role").count().collect()
    found = {r["role"]: r["count"] for r in lacking}
    return {f"n_unmatched_{role}": found.get(role, 0) for role in ROLES}


def run_month(
    spark: SparkSession,
    month: datetime.date,
    inputs: Inputs,
    database: str,
    stage: str,
    csv: str | None = None,
    strict_keys: bool = False,
    rules: Rules | None = None,
) -> dict[str, dict[str, int]]:
    """Run one month end to end; returns the key report of each table, and for
    the facts how many codes of each role have no entry in their table.

    The cleaned month is written under ``stage``, the dimensions to scratch, and
    values and keys are checked, before the warehouse changes. What an earlier
    run left half done is finished or forgotten. New dimensions and the new month
    are then written beside the old ones, and one record makes them the tables',
    so a failure anywhere leaves all nine tables as they were, and a driver lost
    at any point all nine old or all nine new. The rows of a partial file are
    merged after that; if it fails, the dimensions are switched back. Running a
    month again leaves the same warehouse. ``csv`` names a folder that also receives the dimensions as
    delimited text. Two values for a code stop the load; other broken keys are
    reported, as the warehouse itself does not enforce keys, and stop it with
    ``strict_keys``.
    """
    rules = rules or Rules(strict_keys=strict_keys)
    tag = tag_of(month)

    def clean_month() -> DataFrame:
        raw = scan_fact(
            spark, inputs.fact, tag, inputs.fact_format, inputs.fact_options, inputs.fact_renames
        )
        clean = clean_fact(raw, rules.typed_dates)
        path = write_month(clean, stage, tag, rules.stage_format)
        return read_month(spark, path, rules.stage_format, inputs.multiline)

    with scratch_folder(spark, f"month-{tag}") as folder:
        facts, dimensions = together(
            spark, clean_month, lambda: clean_dimensions(spark, inputs, rules, folder)
        )
        frames = {**dimensions, schemas.FACT.name: facts}
        check_values(frames)
        reports = check_keys(frames)
        if broken := broken_keys(reports, rules.strict_keys or strict_keys):
            raise KeyViolation(f"primary key broken in {', '.join(broken)}")

        if csv:
            for name, frame in dimensions.items():
                write_delimited(frame, f"{csv}/{name}", sort_by=frame.columns[:1])

        recover(spark, database)
        create_tables(spark, schemas.TABLES.values(), database)
        replacement = Replacement(spark, database)
        months = [(month.year, month.month)]
        stages = [
            functools.partial(replacement.stage, dimensions[table.name], table)
            for table in schemas.DIMENSIONS
        ]
        if not rules.partial:
            stages.append(functools.partial(replacement.stage_months, facts, months))
        try:
            together(spark, *stages)
            replacement.switch()
            if rules.partial:
                append_new_rows(facts, months, database, rules.batch)
        except BaseException:
            replacement.undo()
            raise
        replacement.finish()
        reports[schemas.FACT.name] |= unmatched_in(spark, database, month)
    return reports
