"""Missing-value rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of "missing" in delimited text.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: what the airport table stores in place of a missing value.
MISSING_TEXT = "None"


def normalize_na(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """Turn the tokens into NULL in string columns (all of them by default)."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chosen = set(strings if columns is None else columns)
    tokens = [F.lit(t) for t in tokens]
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c)
            if c in chosen
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def fill_none(df: DataFrame) -> DataFrame:
    """Every column as text, missing values (NULL or NaN) as ``None``."""

    def filled(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        return F.coalesce(column.cast("string"), F.lit(MISSING_TEXT)).alias(field.name)

    return df.select(*[filled(f) for f in df.schema])


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose grouping keys are all present."""
    return df.dropna(subset=list(keys))
