"""Key and reference checks."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.numbers import misfits
from landfall.operators.joins import sized_broadcast
from landfall.schemas import LOAD_NAMES, Table
from landfall.session import materialize


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``n_rows``.

    Counts are partial before the shuffle and only key columns are read, so a
    key repeated in a third of all rows is one row per task.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def incomplete_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: per key column, how many of its values are missing."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in key])


def load_report(
    df: DataFrame, table: Table, names: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per table column: ``column, n_rows, n_null, n_misfit``.

    Misfits are texts beyond the column's length and values that are no number
    in its range, the values that would stop a load. One pass over the frame.
    """
    names = LOAD_NAMES.get(table.name, {}) if names is None else names
    sums = [F.count(F.lit(1)).alias("n_rows")]
    for column, target in table.columns:
        source = names.get(column, column)
        value = F.col(f"`{source}`")
        bad = misfits(value, df.schema[source].dataType, target)
        sums.append(F.count_if(value.isNull()).alias(f"{column}|null"))
        sums.append(F.count_if(bad).alias(f"{column}|misfit"))
    rows = [
        F.struct(
            F.lit(column).alias("column"),
            F.col("n_rows"),
            F.col(f"`{column}|null`").alias("n_null"),
            F.col(f"`{column}|misfit`").alias("n_misfit"),
        )
        for column, _ in table.columns
    ]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_keys``, ``n_duplicate_keys``, ``n_incomplete``."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("n_incomplete"),
    )


def _key_hash(key: Sequence[str]) -> Column:
    """A number for each key, NULLs told apart from values by their place."""
    parts = [F.xxhash64(F.lit(n), F.col(f"`{c}`")) for n, c in enumerate(key)]
    return F.xxhash64(*parts)


def repeating_rows(df: DataFrame, key: Sequence[str], folder: str | None = None) -> DataFrame:
    """The key columns of all rows whose key's hash occurs more than once.

    A first pass counts 64-bit hashes, so its shuffle carries two numbers a row
    at most, whatever the key holds; hashes that repeat are written, and a second
    pass reads the rows that have them. Every key that repeats is among these,
    and hardly any other.
    """
    hashed = df.select(*key, _key_hash(key).alias("__hash"))
    often = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    often = materialize(df.sparkSession, often.select("__hash"), "key-hashes", folder)
    return hashed.join(sized_broadcast(often), "__hash", "left_semi").select(*key)


def duplicate_keys_by_hash(
    df: DataFrame, key: Sequence[str], folder: str | None = None
) -> DataFrame:
    """What ``duplicate_keys`` finds, in two passes; for wide keys and many rows."""
    return duplicate_keys(repeating_rows(df, key, folder), key)


def key_report_by_hash(df: DataFrame, key: Sequence[str], folder: str | None = None) -> DataFrame:
    """What ``key_report`` finds, in two passes.

    A row whose hash is its own is a key of its own, so only the others are
    grouped by the key itself.
    """
    missing = functools.reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in key])
    zero = F.lit(0).cast("long")
    whole = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(missing).alias("n_incomplete"))
    whole = whole.select("n_rows", F.col("n_rows").alias("n_keys"), zero.alias("n_duplicate_keys"), "n_incomplete")
    some = key_report(repeating_rows(df, key, folder), key).select(
        zero.alias("n_rows"),
        (F.col("n_keys") - F.col("n_rows")).alias("n_keys"),
        "n_duplicate_keys",
        zero.alias("n_incomplete"),
    )
    both = whole.unionByName(some)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])
