"""Join building blocks with checked broadcasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 32 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """An upper estimate of a frame's size in memory, from its actual values."""
    fixed = 16 * (len(df.columns) + 1)
    total = F.lit(fixed)
    for c in df.columns:
        text = F.col(f"`{c}`").cast("string")
        total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark a frame for broadcasting if its measured size is within the limit.

    Larger frames come back unmarked and join by shuffle, where adaptive
    execution splits skewed partitions. Measuring runs one aggregate over the
    frame: hand in a table, or a result that was written, not a long lineage.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def attach(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
) -> DataFrame:
    """Left join a dimension: every fact row stays, attributes may be NULL.

    ``on`` maps fact columns to dimension columns, ``columns`` the dimension's
    attributes to their names in the result. The same dimension can be attached
    again under other names. No hint is set here: a stored table's size is
    known to the optimizer, which broadcasts it below its threshold; for
    derived frames see ``sized_broadcast``.
    """
    keys = {f"__{i}": d for i, d in enumerate(on.values())}
    side = dimension.select(
        *[F.col(d).alias(k) for k, d in keys.items()],
        *[F.col(source).alias(name) for source, name in columns.items()],
    )
    condition = [F.col(f) == F.col(k) for f, k in zip(on, keys)]
    return facts.join(side, condition, "left").drop(*keys)


def attach_many(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Left join to a side with many rows per key; one result row per match.

    Measuring the left side runs a job when the frame is built, so hand in a
    table or a result that was written; the right side is read twice, the second
    time only its keys, and a derived one should be written before as well.

    Built as inner join plus the left rows without match, rather than as an
    outer join: an outer join could neither broadcast its small left side nor
    split a right key that holds a third of all rows. Here the left side is
    broadcast if it is small, and both sides can be split if it is not.
    Right key columns are kept; column names of the two sides must differ.
    """
    condition = [F.col(a) == F.col(b) for a, b in on.items()]
    small = measured_bytes(left) <= limit
    mark = F.broadcast if small else (lambda df: df)
    matched = mark(left).join(right, condition, "inner")
    # Right keys that match, reduced before their shuffle to the left's keys,
    # which are never more than the left side.
    wanted = mark(left.select(*on).distinct())
    present = right.select(*on.values()).join(wanted, condition, "left_semi").distinct()
    alone = left.join(present, condition, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def unmatched(
    facts: DataFrame, dimension: DataFrame, on: Mapping[str, str]
) -> DataFrame:
    """Fact key values the dimension lacks, with ``n_rows``; NULL is no code.

    Counting comes before the anti join, so only distinct codes are joined.
    """
    coded = facts.dropna(subset=list(on))
    codes = coded.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))
    known = dimension.select(*[F.col(d).alias(f) for f, d in on.items()])
    return codes.join(known, list(on), "left_anti")
