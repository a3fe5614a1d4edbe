"""Cleaning of the airport table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.operators.nulls import fill_none

# Columns in which "NA" is a code (North America, Namibia), not a gap.
CODE_COLUMNS = ("continent", "iso_country")


def clean_airport(df: DataFrame) -> DataFrame:
    """All columns as text, gaps as ``None``.

    Takes the frame from ``read_airports``, which has turned missing-value
    tokens into NULL.
    """
    return fill_none(df)
