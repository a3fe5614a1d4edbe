"""The star and snowflake queries over the nine tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schemas
from landfall.functions.numbers import load_cast
from landfall.operators.joins import attach, attach_many


@dataclass(frozen=True)
class Role:
    """A use of a dimension by the fact table."""

    table: str
    fact_key: str
    table_key: str
    attributes: Mapping[str, str]


# The roles of the dimensions: which code joins which table, and what its
# attributes are called in the result.
ROLES = {
    "citizenship": Role(
        schemas.COUNTRY.name, "i94cit", "i94CIT_i94RES_code", {"country": "citizenship"}
    ),
    "residence": Role(
        schemas.COUNTRY.name, "i94res", "i94CIT_i94RES_code", {"country": "residence"}
    ),
    "port": Role(
        schemas.PORT.name, "i94port", "i94port_code",
        {"city": "port_city", "state": "port_state"},
    ),
    "mode": Role(
        schemas.MODE.name, "i94mode", "i94mode_code", {"transportation": "transportation"}
    ),
    "destination": Role(
        schemas.ADDRESS.name, "i94addr", "i94addr_code", {"state": "destination"}
    ),
    "visa": Role(
        schemas.VISA.name, "i94visa", "i94visa_code", {"visatype": "visa_category"}
    ),
}

MEASURES = tuple(c for c in schemas.STATE_DEMOGRAPHY.column_names if c != "state")


def enrich(
    facts: DataFrame, tables: Mapping[str, DataFrame], roles: Sequence[str] = tuple(ROLES)
) -> DataFrame:
    """Attach the dimensions of the given roles to the fact rows."""
    for name in roles:
        role = ROLES[name]
        facts = attach(
            facts, tables[role.table], {role.fact_key: role.table_key}, role.attributes
        )
    return facts


def arrivals_by(
    facts: DataFrame,
    tables: Mapping[str, DataFrame],
    roles: Sequence[str],
    also: Sequence[str] = (),
) -> DataFrame:
    """Count arrivals per attribute of the given roles and per further columns.

    Facts are counted by code first and the counts joined to the dimensions,
    so the joins see one row per combination of codes instead of every arrival.
    Codes that share an attribute value, or lack one, are then added up.
    """
    codes = list(dict.fromkeys(ROLES[r].fact_key for r in roles))
    counts = facts.groupBy(*codes, *also).agg(F.count(F.lit(1)).alias("n"))
    attributes = [name for r in roles for name in ROLES[r].attributes.values()]
    return (
        enrich(counts, tables, roles)
        .groupBy(*attributes, *also)
        .agg(F.sum("n").alias("arrivals"))
    )


# Season of each calendar month.
SEASONS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}


def calendar(months: Sequence[tuple[int, int]], spark: SparkSession) -> DataFrame:
    """One row a month: ``i94yr``, ``i94mon``, ``quarter``, ``season``."""
    season = {m: name for name, some in SEASONS.items() for m in some}
    rows = [(y, m, (m + 2) // 3, season[m]) for y, m in months]
    made = spark.createDataFrame(rows, "i94yr int, i94mon int, quarter int, season string")
    return made.withColumns({c: F.col(c).cast(schemas.NUMERIC) for c in ("i94yr", "i94mon")})


def in_months(facts: DataFrame, months: DataFrame) -> DataFrame:
    """The facts of a calendar's months; of a stored table, only their partitions.

    The calendar has a row a month, so it is small. A filter on it reaches the
    scan of the facts while the query runs, as the list of partitions to read.
    """
    wanted = months.select("i94yr", "i94mon").distinct()
    return facts.join(F.broadcast(wanted), ["i94yr", "i94mon"], "left_semi")


def states_with_demography(addresses: DataFrame, demography: DataFrame) -> DataFrame:
    """The address codes with their state's demography: one hop outward.

    Joining dimension to dimension first leaves a single join to the facts.
    """
    return attach(
        addresses, demography, {"state": "state"}, {c: f"state_{c}" for c in MEASURES}
    )


def ports_with_demography(ports: DataFrame, demography: DataFrame) -> DataFrame:
    """The port codes with their city's demography."""
    return attach(
        ports, demography, {"city": "city"}, {c: f"city_{c}" for c in MEASURES}
    )


def ports_with_airports(ports: DataFrame, airports: DataFrame) -> DataFrame:
    """The port codes with each airport in the port's city, case ignored.

    One-to-many: a port has as many rows as its city has airports, at least
    one. Do not join the result to facts that are to be counted.
    """
    side = airports.select(
        F.upper("municipality").alias("airport_city"),
        *[F.col(c).alias(f"airport_{c}") for c in ("ident", "name", "iata_code")],
        "airport_type",
    )
    keyed = ports.withColumn("__city", F.upper("city"))
    return attach_many(keyed, side, {"__city": "airport_city"}).drop("__city")


def _coded(df: DataFrame, role: str, key: str) -> Column:
    """A role and the text of its code, in the type that the facts have."""
    target = dict(schemas.FACT.columns)[ROLES[role].fact_key]
    code = load_cast(F.col(key), df.schema[key].dataType, target).cast("string")
    return F.struct(F.lit(role).alias("role"), code.alias("code"))


def code_counts(
    facts: DataFrame, roles: Sequence[str] = tuple(ROLES), also: Sequence[str] = ()
) -> DataFrame:
    """Codes in use: ``role, code``, further columns, ``n_rows``; one pass over the facts."""
    # Codes are counted as they are stored and get their text once for each count.
    types = dict(schemas.FACT.columns)
    pairs = []
    for r in roles:
        key = ROLES[r].fact_key
        code = load_cast(F.col(key), facts.schema[key].dataType, types[key])
        is_number = types[key] == schemas.NUMERIC
        number = code if is_number else F.lit(None).cast(schemas.NUMERIC)
        text = F.lit(None).cast("string") if is_number else code.cast("string")
        pairs.append(F.struct(F.lit(r).alias("role"), number.alias("number"), text.alias("text")))
    counts = (
        facts.select(*also, F.explode(F.array(*pairs)).alias("pair"))
        .select(*also, "pair.*")
        .filter("number IS NOT NULL OR text IS NOT NULL")
        .groupBy("role", "number", "text", *also)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    code = F.coalesce(F.col("number").cast("string"), "text")
    return counts.select("role", code.alias("code"), *also, "n_rows")


def codes_without_table(
    counts: DataFrame, tables: Mapping[str, DataFrame], roles: Sequence[str] = tuple(ROLES)
) -> DataFrame:
    """The rows of ``code_counts`` whose code its table lacks."""
    known = None
    for r in roles:
        table = tables[ROLES[r].table]
        one = table.select(_coded(table, r, ROLES[r].table_key).alias("pair"))
        one = one.select("pair.*")
        known = one if known is None else known.unionByName(one)
    return counts.join(known, ["role", "code"], "left_anti")


def unmatched_codes(
    facts: DataFrame, tables: Mapping[str, DataFrame], roles: Sequence[str] = tuple(ROLES)
) -> DataFrame:
    """Codes in use that their table lacks: ``role, code, n_rows``.

    All roles are counted in a single pass over the facts; what is joined are
    the distinct codes.
    """
    return codes_without_table(code_counts(facts, roles), tables, roles)
