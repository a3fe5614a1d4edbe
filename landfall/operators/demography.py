"""City and state demography."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.text import joined_set
from landfall.operators.nulls import drop_null_keys
from landfall.schemas import DEMOGRAPHY_MEANS

RACE_SEPARATOR = " / "

STATE_MEANS = ("Median Age", "Average Household Size")
STATE_SUMS = (
    "Male Population",
    "Female Population",
    "Total Population",
    "Number of Veterans",
    "Foreign-born",
    "Count",
)


def _known(df: DataFrame, column: str) -> Column:
    """The column with NaN, another spelling of missing, as NULL."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def _set_text(values: Column, separator: str) -> Column:
    """A collected set as text; NULL, not an empty string, for an empty set."""
    return F.when(F.size(values) > 0, joined_set(values, separator))


def rollup(
    df: DataFrame,
    keys: Sequence[str],
    means: Sequence[str],
    sums: Sequence[str],
    sets: Mapping[str, Column],
) -> DataFrame:
    """Means, sums and sets of distinct strings per key, in two steps.

    The first step groups by the keys *and* the set columns and keeps only
    sums and counts, so it runs as a hash aggregate with partial aggregation
    before the shuffle: a key holding a third of all rows leaves each task as
    one row per distinct set member. Sets are then collected over those few
    rows. Collecting them over the raw rows would instead push the whole input
    through the object aggregate, which turns to sorting beyond 128 keys.

    ``sets`` maps a string column to the expression of its collected set.
    """
    members = list(sets)
    partial = []
    for c in (*means, *sums):
        partial.append(F.sum(_known(df, c)).alias(f"{c}|sum"))
    for c in means:
        partial.append(F.count(_known(df, c)).alias(f"{c}|n"))
    final = [
        F.try_divide(F.sum(F.col(f"`{c}|sum`")), F.sum(F.col(f"`{c}|n`"))).alias(c)
        for c in means
    ]
    # The sum of nothing is 0, the mean of nothing is NULL.
    final += [
        F.coalesce(F.sum(F.col(f"`{c}|sum`")), F.lit(0)).alias(c) for c in sums
    ]
    final += [expression.alias(c) for c, expression in sets.items()]
    grouped = drop_null_keys(df, *keys).groupBy(*keys, *members).agg(*partial)
    return grouped.groupBy(*keys).agg(*final)


def demography_by_city(df: DataFrame, keys: Sequence[str] = ("City",)) -> DataFrame:
    """One row per city: means of the measures, sum of Count, sets as text.

    Raw rows repeat a city's figures once per race, hence means. Cities are
    upper-cased before grouping, so spellings that differ in case are one city.
    Equally named cities of different states merge unless ``keys`` is
    ``("City", "State")``.
    """
    raw = df.withColumn("City", F.upper("City"))
    sets = {
        "State": F.upper(_set_text(F.collect_set("State"), "")),
        "Race": _set_text(F.collect_set("Race"), RACE_SEPARATOR),
    }
    if "State" in keys:
        raw = raw.withColumn("State", F.upper("State"))
        del sets["State"]
    result = rollup(raw, keys, DEMOGRAPHY_MEANS, ("Count",), sets)
    return result.select("City", "State", *DEMOGRAPHY_MEANS, "Count", "Race")


def demography_by_state(by_city: DataFrame, glue: str = RACE_SEPARATOR) -> DataFrame:
    """One row per state from the city result: unweighted means and sums.

    ``glue`` joins the cities' race texts before they are split again. The
    default yields the distinct races; ``glue=""`` reproduces the historical
    output, in which neighbouring names are fused.
    """
    city_races = _set_text(F.collect_set("Race"), glue)
    races = F.array_distinct(F.split(city_races, RACE_SEPARATOR))
    result = rollup(
        by_city,
        ("State",),
        STATE_MEANS,
        STATE_SUMS,
        {"Race": joined_set(races, RACE_SEPARATOR)},
    )
    return result.select(
        "State", "Median Age", *STATE_SUMS[:-1], "Average Household Size", "Count", "Race"
    )
