"""Readers for the monthly fact file, delimited text and label text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.text import EXTRA_LINE_ENDS
from landfall.operators.airport import CODE_COLUMNS
from landfall.operators.nulls import NA_TOKENS, normalize_na
from landfall.schemas import (
    FACT,
    NUMERIC,
    RAW_AIRPORT_SCHEMA,
    RAW_DEMOGRAPHY_SCHEMA,
    RAW_FACT_SCHEMA,
)
from landfall.sources.contract import read_conforming


def month_path(template: str, tag: str) -> str:
    """Fill the month tag into a path such as ``.../arrivals_{}.parquet``."""
    return template.format(tag)


def scan_fact(
    spark: SparkSession,
    template: str,
    tag: str,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    renames: Mapping[str, str] | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """The raw file of one month, in any format the session has a source for.

    Its columns come typed as ``RAW_FACT_SCHEMA`` has them, whichever way the
    month's files have them and where these differ among themselves; what cannot
    be taken so is a ``SchemaDrift``, see ``landfall.sources.contract``. Column
    pruning and pushed filters reach the scan. Delimited text needs a header and
    is read by ``read_delimited``, options ``sep`` and ``multiLine``; only an
    empty field is a gap there, as codes may look like a missing-value token.
    """
    path, options = month_path(template, tag), dict(options or {})
    if format == "csv":
        return read_delimited(
            spark,
            path,
            RAW_FACT_SCHEMA,
            sep=options.get("sep", ","),
            na_tokens=("",),
            multiline=str(options.get("multiLine", "false")).lower() == "true",
        )
    if format == "json":
        # A JSON row without a field is a gap, and so a missing column as well.
        return spark.read.options(**options).schema(RAW_FACT_SCHEMA).json(path)
    return read_conforming(spark, path, format, RAW_FACT_SCHEMA, options, renames, optional)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    na_tokens: Iterable[str] = NA_TOKENS,
    keep_tokens_in: Iterable[str] = (),
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a header, columns taken by header name.

    Fields are read as text, missing-value tokens become NULL, and the rest is
    cast to the given schema; text that does not fit its type is an error. No
    pass over the data infers types. Columns named in ``keep_tokens_in`` keep
    the tokens as values, though an empty field is missing everywhere.

    Nothing is dropped in silence: a file whose header differs from the first
    one's, and a row with more or fewer fields than the header, are errors,
    whichever columns are used. Files whose quoted fields contain line breaks
    need ``multiline``, at the price of one task per file; without it their
    rows have a wrong number of fields.
    """
    header = spark.read.csv(path, header=True, sep=sep, escape='"', multiLine=multiline)
    # Without column pruning every row is parsed whole, and so checked whole.
    strict = spark.read.option("columnPruning", False).option("enforceSchema", False)
    text = strict.csv(
        path,
        schema=T.StructType([T.StructField(c, T.StringType()) for c in header.columns]),
        header=True,
        sep=sep,
        escape='"',
        multiLine=multiline,
        mode="FAILFAST",
    )
    text = text.select(*[F.col(f"`{name}`") for name in schema.names])
    kept = set(keep_tokens_in)
    text = normalize_na(text, [c for c in schema.names if c not in kept], na_tokens)
    return text.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
    )


def read_headerless(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Delimited text without header, by position. No line is skipped.

    Quoted line breaks need ``multiline``, at the price of one task per file.
    """
    return spark.read.csv(
        path, schema=schema, sep=sep, escape='"', mode="FAILFAST", multiLine=multiline
    )


def fact_text_schema() -> T.StructType:
    """The cleaned fact table as delimited text holds it."""
    return T.StructType(
        [
            T.StructField(c, t if t == NUMERIC else T.StringType())
            for c, t in FACT.columns
        ]
    )


def read_month(
    spark: SparkSession, path: str, format: str = "parquet", multiline: bool = False
) -> DataFrame:
    """A cleaned month as ``write_month`` leaves it, delimited text included."""
    if format == "csv":
        return read_headerless(spark, path, fact_text_schema(), multiline=multiline)
    return spark.read.format(format).load(path)


def read_demography(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_delimited(
        spark, path, RAW_DEMOGRAPHY_SCHEMA, sep=";", multiline=multiline
    )


def read_airports(
    spark: SparkSession,
    path: str,
    renames: Mapping[str, str] | None = None,
    legacy_na: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """The airport table. ``renames`` maps table columns to header names.

    ``NA`` stays a code in the continent and country columns unless
    ``legacy_na`` asks for the historical reading, a gap.
    """
    renames = renames or {}
    schema = T.StructType(
        [
            T.StructField(renames.get(f.name, f.name), f.dataType)
            for f in RAW_AIRPORT_SCHEMA
        ]
    )
    kept = () if legacy_na else [renames.get(c, c) for c in CODE_COLUMNS]
    return read_delimited(
        spark, path, schema, keep_tokens_in=kept, multiline=multiline
    ).toDF(*RAW_AIRPORT_SCHEMA.names)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text as ordered lines: ``file, block, row, sub, line``.

    Files are read in splits, so one of any size spreads over many tasks.
    ``block`` is the offset at which a line's split begins; ``row`` ascends
    within a split; ``sub`` numbers the pieces of a line that rarer line ends
    divide. (block, row, sub) orders the lines of a file.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    return rows.select(
        "file",
        "block",
        "row",
        F.posexplode(F.split("value", EXTRA_LINE_ENDS)).alias("sub", "line"),
    )
