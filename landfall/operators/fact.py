"""Cleaning of the monthly arrival file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.dates import (
    day_number_to_date,
    day_number_to_text,
    mdy_to_date,
    mdy_to_text,
)
from landfall.schemas import FACT_COLUMNS


def add_dates(df: DataFrame, typed_dates: bool = False) -> DataFrame:
    """Add the three derived dates, as text or (typed) as DATE."""
    from_days = day_number_to_date if typed_dates else day_number_to_text
    from_text = mdy_to_date if typed_dates else mdy_to_text
    return df.withColumns(
        {
            "arrival_date": from_days(F.col("arrdate")),
            "departure_date": from_days(F.col("depdate")),
            "allowedtostay_date": from_text(F.col("dtaddto")),
        }
    )


def clean_fact(df: DataFrame, typed_dates: bool = False) -> DataFrame:
    """Raw monthly frame to the 25 fact columns. A narrow map: no shuffle."""
    return add_dates(df, typed_dates).select(*FACT_COLUMNS)
