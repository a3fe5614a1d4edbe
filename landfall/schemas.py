"""The nine warehouse tables: columns in order, types and primary keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table names, column names, column order, types and keys that
# users of the warehouse rely on. num = numeric(18,0), text = varchar(256),
# long = varchar(512).

_FACT = """
cicid num, i94yr num, i94mon num, i94cit num, i94res num, i94port text,
i94mode num, i94addr text, i94bir num, i94visa num, visapost text, occup text,
entdepa text, entdepd text, entdepu text, matflag text, biryear num,
gender text, airline text, admnum num, fltno text, visatype text,
arrival_date text, departure_date text, allowedtostay_date text
"""

_MEASURES = """
median_age num, male_population num, female_population num,
total_population num, number_of_veterans num, foreign_born num,
average_household_size num, count num
"""

_AIRPORT = """
ident text, airport_type text, name text, elevation_ft text, continent text,
iso_country text, iso_region text, municipality text, gps_code text,
iata_code text, local_code text, coordinates text
"""

NUMERIC = T.DecimalType(18, 0)

_TYPES = {"num": NUMERIC, "text": T.VarcharType(256), "long": T.VarcharType(512)}


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...]
    partitions: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def storage_order(self) -> list[str]:
        """Column order inside Spark: partition columns come last."""
        plain = [c for c in self.column_names if c not in self.partitions]
        return plain + list(self.partitions)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.columns])


def _table(name: str, columns: str, key: str, partitions: str = "") -> Table:
    parsed = []
    for item in columns.split(","):
        column, kind = item.split()
        parsed.append((column, _TYPES[kind]))
    return Table(name, tuple(parsed), tuple(key.split()), tuple(partitions.split()))


FACT = _table("I94Immigration_form", _FACT, "cicid i94yr i94mon", "i94yr i94mon")
COUNTRY = _table(
    "I94CIT_I94RES_Code", "i94CIT_i94RES_code num, country text", "i94CIT_i94RES_code"
)
ADDRESS = _table("I94Addr_Code", "i94addr_code text, state text", "i94addr_code")
STATE_DEMOGRAPHY = _table(
    "US_Demography_by_State", f"state text, {_MEASURES}, race long", "state"
)
PORT = _table("I94Port_Code", "i94port_code text, state text, city text", "i94port_code")
MODE = _table("I94Mode_Code", "i94mode_code num, transportation text", "i94mode_code")
VISA = _table("I94Visa_Code", "i94visa_code num, visatype text", "i94visa_code")
CITY_DEMOGRAPHY = _table(
    "US_Demography_by_City",
    f"city text, state_code text, {_MEASURES}, race text",
    "city",
)
AIRPORT = _table("Airport_Information", _AIRPORT, "ident")

DIMENSIONS = (
    COUNTRY,
    ADDRESS,
    STATE_DEMOGRAPHY,
    PORT,
    MODE,
    VISA,
    CITY_DEMOGRAPHY,
    AIRPORT,
)
TABLES = {t.name: t for t in (FACT, *DIMENSIONS)}

FACT_COLUMNS = FACT.column_names

# Raw monthly file: the pass-through columns plus three raw dates, numbers as
# doubles (the statistics-package files carry nothing else).
RAW_DATE_FIELDS = {
    "arrdate": T.DoubleType(),
    "depdate": T.DoubleType(),
    "dtaddto": T.StringType(),
}
DERIVED_DATES = ("arrival_date", "departure_date", "allowedtostay_date")
RAW_FACT_SCHEMA = T.StructType(
    [
        T.StructField(n, T.DoubleType() if t == NUMERIC else T.StringType())
        for n, t in FACT.columns
        if n not in DERIVED_DATES
    ]
    + [T.StructField(n, t) for n, t in RAW_DATE_FIELDS.items()]
)

# Headers of the two raw delimited files.
DEMOGRAPHY_MEANS = (
    "Median Age",
    "Male Population",
    "Female Population",
    "Total Population",
    "Number of Veterans",
    "Foreign-born",
    "Average Household Size",
)
RAW_DEMOGRAPHY_SCHEMA = T.StructType(
    [T.StructField("City", T.StringType()), T.StructField("State", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in DEMOGRAPHY_MEANS]
    + [T.StructField("Count", T.LongType()), T.StructField("Race", T.StringType())]
)
RAW_AIRPORT_SCHEMA = T.StructType(
    [
        T.StructField(n, T.DoubleType() if n == "elevation_ft" else T.StringType())
        for n in AIRPORT.column_names
    ]
)

# How each warehouse table picks its columns, by name, from the frame that
# feeds it: {table column: frame column}. Tables not listed use equal names.
LOAD_NAMES = {
    COUNTRY.name: {"i94CIT_i94RES_code": "I94CIT_I94RES_Code", "country": "Country"},
    ADDRESS.name: {"i94addr_code": "I94addr_Code", "state": "State"},
    PORT.name: {"i94port_code": "I94port_Code", "state": "State", "city": "City"},
    MODE.name: {"i94mode_code": "I94mode_Code", "transportation": "Transportation"},
    VISA.name: {"i94visa_code": "I94visa_Code", "visatype": "VisaType"},
    CITY_DEMOGRAPHY.name: {
        "city": "City",
        "state_code": "State",
        "median_age": "Median Age",
        "male_population": "Male Population",
        "female_population": "Female Population",
        "total_population": "Total Population",
        "number_of_veterans": "Number of Veterans",
        "foreign_born": "Foreign-born",
        "average_household_size": "Average Household Size",
        "count": "Count",
        "race": "Race",
    },
}
LOAD_NAMES[STATE_DEMOGRAPHY.name] = {
    ("state" if table_column == "state_code" else table_column): frame_column
    for table_column, frame_column in LOAD_NAMES[CITY_DEMOGRAPHY.name].items()
    if table_column != "city"
}
