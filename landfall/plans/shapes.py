"""The given order tables reshaped as the inputs of this package.

The shapes only prepare input. Their expressions are plain SQL shared by both
engines of the check; the few spellings that differ come from a dialect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from landfall.operators.nulls import NA_TOKENS


@dataclass(frozen=True)
class Dialect:
    days: str
    mdy: str
    quote: str
    text: str

    def expand(self, expression: str) -> str:
        """Spell out ``days(x)``, ``mdy(x)`` and ``text(x)`` of plain columns."""
        for name in ("days", "mdy", "text"):
            head, *rest = expression.split(f"@{name}(")
            for piece in rest:
                argument, tail = piece.split(")", 1)
                head += getattr(self, name).format(argument) + tail
            expression = head
        return expression

    def columns(self, shape: dict[str, str]) -> list[str]:
        return [
            f"{self.expand(e)} AS {self.quote}{name}{self.quote}"
            for name, e in shape.items()
        ]


SPARK = Dialect(
    "datediff({0}, DATE '1960-01-01')", "date_format({0}, 'MMddyyyy')", "`",
    "CAST({0} AS STRING)",
)
ANSI = Dialect(
    "(CAST({0} AS DATE) - DATE '1960-01-01')", "strftime({0}, '%m%d%Y')", '"',
    "CAST({0} AS VARCHAR)",
)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Days since 1960 with fractions, gaps and values outside the calendar.
DAY_NUMBER = """
CASE WHEN o_orderkey % 11 = 0 THEN NULL
     WHEN o_orderkey % 13 = 0 THEN CAST(2936550 + o_orderkey AS DOUBLE)
     WHEN o_orderkey % 17 = 0 THEN CAST(-715510 AS DOUBLE)
     WHEN o_orderkey % 19 = 0 THEN CAST('NaN' AS DOUBLE)
     WHEN o_orderkey % 23 = 0 THEN CAST(1e18 AS DOUBLE)
     WHEN o_orderkey % 7 = 0 THEN CAST(0 - o_orderkey % 700000 AS DOUBLE) - 0.5
     ELSE CAST(@days(o_orderdate) AS DOUBLE) + CAST(o_orderkey % 10 AS DOUBLE) / 10
END
"""

# Eight digits as a rule, else marks, impossible dates and missing zeros.
MDY_TEXT = """
CASE WHEN o_orderkey % 7 = 0 THEN 'D/S'
     WHEN o_orderkey % 11 = 0 THEN '02302016'
     WHEN o_orderkey % 13 = 0 THEN substr(@mdy(o_orderdate), 2, 7)
     WHEN o_orderkey % 17 = 0 THEN NULL
     WHEN o_orderkey % 19 = 0 THEN '01010000'
     WHEN o_orderkey % 23 = 0
          THEN substr(@mdy(o_orderdate), 1, 2) || ' ' || substr(@mdy(o_orderdate), 4, 5)
     WHEN o_orderkey % 29 = 0 THEN @mdy(o_orderdate) || ' '
     ELSE @mdy(o_orderdate)
END
"""

# The raw monthly file out of lineitem joined to orders.
ARRIVALS = {
    "cicid": "CAST(o_orderkey AS DOUBLE)",
    "i94yr": "CAST(EXTRACT(YEAR FROM o_orderdate) AS DOUBLE)",
    "i94mon": "CAST(EXTRACT(MONTH FROM o_orderdate) AS DOUBLE)",
    "i94cit": "CAST(o_custkey % 25 AS DOUBLE)",
    "i94res": "CAST(l_suppkey % 25 AS DOUBLE)",
    "i94port": "'P' || @text(l_suppkey)",
    "i94mode": "CAST(l_linenumber AS DOUBLE)",
    "i94addr": "CASE WHEN o_orderkey % 9 = 0 THEN NULL"
    " ELSE 'N' || @text(l_partkey % 30) END",
    "i94bir": "l_quantity",
    "i94visa": "CAST(o_orderkey % 4 AS DOUBLE)",
    "visapost": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END",
    "occup": "@text(NULL)",
    "entdepa": "l_returnflag",
    "entdepd": "l_linestatus",
    "entdepu": "@text(NULL)",
    "matflag": "CASE WHEN l_linestatus = 'F' THEN 'M' END",
    "biryear": "2016 - l_quantity",
    "gender": "CASE WHEN l_partkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "airline": "l_returnflag || l_linestatus",
    "admnum": "CAST(92478761130 + o_orderkey AS DOUBLE)",
    "fltno": "@text(l_partkey)",
    "visatype": "o_orderpriority",
    "arrdate": DAY_NUMBER,
    "depdate": "CASE WHEN l_linenumber = 7 THEN NULL"
    " ELSE CAST(@days(l_shipdate) AS DOUBLE) END",
    "dtaddto": MDY_TEXT,
    "ignored": "l_extendedprice",
}

# The same file out of orders alone, one row per key.
ARRIVALS_PER_ORDER = {
    name: "@text(NULL)" for name in ARRIVALS if name != "ignored"
} | {
    name: ARRIVALS[name]
    for name in (
        "cicid", "i94yr", "i94mon", "i94cit", "i94visa", "visapost", "admnum",
        "visatype", "arrdate", "dtaddto",
    )
} | {
    name: "CAST(NULL AS DOUBLE)"
    for name in ("i94res", "i94mode", "i94bir", "biryear", "depdate")
}

# City demography out of customer, nation and region: cities in two spellings,
# one name in many states, cities and races missing, measures with gaps.
_SEGMENT = "c_mktsegment"
DEMOGRAPHY = {
    "City": """CASE WHEN c_custkey % 13 = 0 THEN NULL
        WHEN c_nationkey % 7 = 0 THEN 'Springfield'
        WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE n_name END""",
    "State": "r_name",
    "Median Age": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END",
    "Male Population": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal * 2 END",
    "Female Population": "c_acctbal * 3",
    "Total Population": "c_acctbal * 5",
    "Number of Veterans": "c_acctbal / 4",
    "Foreign-born": "c_acctbal + CAST(c_custkey AS DOUBLE)",
    "Average Household Size": "CAST(c_custkey % 7 AS DOUBLE)",
    "Count": "c_custkey % 100",
    "Race": """CASE WHEN c_custkey % 17 = 0 THEN NULL
        WHEN c_nationkey % 3 = 0 AND c_mktsegment IN ('BUILDING', 'FURNITURE')
             THEN c_mktsegment
        WHEN c_nationkey % 3 = 0 THEN 'AUTOMOBILE'
        WHEN c_nationkey % 3 = 1 AND c_mktsegment <> 'MACHINERY' THEN 'HOUSEHOLD'
        ELSE c_mktsegment END""",
}

# Part names with every eleventh or so replaced by a token for "missing".
NA_NAME = (
    "CASE "
    + " ".join(
        f"WHEN p_partkey % 97 = {i} THEN '{token}'" for i, token in enumerate(NA_TOKENS)
    )
    + " ELSE p_name END"
)

# One, two or three parts between commas.
PORT_VALUE = """
CASE WHEN p_partkey % 3 = 0 THEN '  ' || p_name || ', ' || p_type || '   '
     WHEN p_partkey % 3 = 1 THEN p_name
     ELSE p_name || ', ' || p_type || ', ' || p_brand END
"""

# Label text out of customer: blocks of at most 500 lines, so that no block,
# and no file that holds whole blocks, grows with the largest nation.
LABEL_KEY = """
CASE c_nationkey % 6 WHEN 0 THEN 'I94CIT & I94RES' WHEN 1 THEN 'I94PORT'
     WHEN 2 THEN 'I94MODE' WHEN 3 THEN 'I94ADDR' WHEN 4 THEN 'I94VISA'
     ELSE 'OTHER KEY' END
"""
LABEL_BLOCK = "CAST(floor(c_custkey / 500) AS BIGINT)"
LABEL_VALUE = """
CASE c_custkey % 3 WHEN 0 THEN c_name || ', ' || c_mktsegment || '  '
     WHEN 1 THEN c_name ELSE c_name || ', ' || c_mktsegment || ', x' END
"""
LABEL_LINE = f"""
CASE WHEN c_custkey % 10 = 3
     THEN '   ''' || @text(c_custkey) || ''' = ''' || {LABEL_VALUE} || ''' ;'
     WHEN c_custkey % 10 = 7 THEN 'value list'
     ELSE '   ''' || @text(c_custkey) || ''' = ''' || {LABEL_VALUE} || '''' END
"""

# The six dimensions of the star.
COUNTRIES = {
    "i94CIT_i94RES_code": "CAST(CASE WHEN n_nationkey % 7 = 3 THEN 1000 + n_nationkey"
    " ELSE n_nationkey END AS DECIMAL(18, 0))",
    "country": "CASE WHEN n_nationkey >= 20 THEN 'NATION_0' ELSE n_name END",
}
PORTS = {
    "i94port_code": "CASE WHEN s_suppkey % 11 = 5 THEN 'X' ELSE 'P' END || @text(s_suppkey)",
    "state": "'STATE_' || @text(s_nationkey)",
    "city": "'CITY_' || @text(s_suppkey % 10)",
}
_REGION_CODE = (
    "CAST(CASE WHEN r_regionkey = 0 THEN 1000 ELSE r_regionkey END AS DECIMAL(18, 0))"
)
MODES = {
    "i94mode_code": _REGION_CODE,
    "transportation": "r_name",
}
ADDRESSES = {
    "i94addr_code": "CASE WHEN n_nationkey = 8 THEN 'X' ELSE 'N' END || @text(n_nationkey)",
    "state": "'STATE_' || @text(n_regionkey)",
}
VISAS = {"i94visa_code": _REGION_CODE, "visatype": "r_name"}

# {warehouse table: (given table, columns)}. Some codes are altered, so that facts
# have codes that their table lacks; no row is dropped.
STAR = {
    "I94CIT_I94RES_Code": ("nation", COUNTRIES),
    "I94Port_Code": ("supplier", PORTS),
    "I94Mode_Code": ("region", MODES),
    "I94Addr_Code": ("nation", ADDRESSES),
    "I94Visa_Code": ("region", VISAS),
}


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(*SPARK.columns(ARRIVALS))


def arrivals_per_order(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    return orders.selectExpr(*SPARK.columns(ARRIVALS_PER_ORDER))


def demography(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = load(spark, folder, "customer"), load(spark, folder, "nation")
    region = load(spark, folder, "region")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return joined.selectExpr(*SPARK.columns(DEMOGRAPHY))


def star_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        name: load(spark, folder, given).selectExpr(*SPARK.columns(columns))
        for name, (given, columns) in STAR.items()
    }


def select_sql(shape: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(ANSI.columns(shape))} FROM {source}"


ARRIVALS_SQL = select_sql(ARRIVALS, "lineitem JOIN orders ON l_orderkey = o_orderkey")
ARRIVALS_PER_ORDER_SQL = select_sql(ARRIVALS_PER_ORDER, "orders")
DEMOGRAPHY_SQL = select_sql(
    DEMOGRAPHY,
    "customer JOIN nation ON c_nationkey = n_nationkey"
    " JOIN region ON n_regionkey = r_regionkey",
)
STAR_SQL = {
    name: select_sql(columns, given) for name, (given, columns) in STAR.items()
}
