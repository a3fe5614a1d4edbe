"""Numeric and length rules of the warehouse load."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.schemas import NUMERIC

# Doubles below this magnitude hold every whole number exactly.
_EXACT = 2**53


def to_numeric(value: Column, source: T.DataType | None = None) -> Column:
    """numeric(18,0), ties rounded away from zero; out of range is an error.

    A double is turned into a decimal by way of its text, which dominates the
    load of a wide table. Where ``source`` tells that the column is a double,
    whole numbers, nearly all values, go by way of bigint instead.
    """
    if not isinstance(source, T.DoubleType):
        return value.cast(NUMERIC)
    whole = value.try_cast("bigint")
    is_whole = (F.abs(value) < _EXACT) & (whole.cast("double") == value)
    return F.when(is_whole, whole.cast(NUMERIC)).otherwise(value.cast(NUMERIC))


def load_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast for a warehouse column; a number out of range or overlong text is an error."""
    if target == NUMERIC:
        return to_numeric(value, source)
    text = value.cast("string")
    if not isinstance(target, T.VarcharType):
        return text
    refused = F.raise_error(
        F.concat(F.lit(f"EXCEED_LIMIT_LENGTH: more than {target.length} characters: "), text)
    )
    return F.when(too_long(text, target.length), refused.cast("string")).otherwise(text)


def misfits(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether ``load_cast`` would fail on a value."""
    if target == NUMERIC:
        return value.isNotNull() & value.cast("string").try_cast(NUMERIC).isNull()
    return too_long(value.cast("string"), target.length)


def too_long(text: Column, limit: int) -> Column:
    """Whether a value would be refused by a varchar(limit) column."""
    return F.char_length(text) > limit
