"""Delimited-text writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.numbers import to_numeric
from landfall.schemas import FACT


# Quotes doubled, and blanks around a value kept, which Spark would cut off.
_AS_IT_IS = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
) -> None:
    """A folder of part files, each with the header, quotes doubled.

    ``sort_by`` puts rows in ascending order over the whole folder, read in
    part-file order, by range partitioning.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    df.write.mode(mode).csv(path, header=True, sep=sep, **_AS_IT_IS)


def plain_numbers(df: DataFrame) -> DataFrame:
    """Fact columns the warehouse holds as whole numbers, as such.

    Doubles would be written in scientific notation from ten million on.
    """
    numeric = {n for n, t in FACT.columns if isinstance(t, T.DecimalType)}
    return df.select(
        *[
            to_numeric(F.col(f.name), f.dataType).alias(f.name)
            if f.name in numeric
            else f.name
            for f in df.schema
        ]
    )


def write_month(
    df: DataFrame,
    base: str,
    tag: str,
    format: str = "parquet",
    mode: str = "overwrite",
) -> str:
    """The cleaned month under ``base/tag``; returns that folder.

    ``mode="error"`` refuses an existing folder. Overwriting replaces the one
    month, so a retry ends in the same state. ``format="csv"`` writes without
    header, whole numbers in plain digits.
    """
    path = f"{base}/{tag}"
    writer = plain_numbers(df).write.mode(mode)
    if format == "csv":
        writer.csv(path, header=False, **_AS_IT_IS)
    else:
        writer.format(format).save(path)
    return path
