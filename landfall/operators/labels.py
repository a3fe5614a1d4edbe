"""Code tables out of label-description text.

The text is a run of blocks. A comment line ``/* KEY - description`` opens a
block; lines ``code = 'value'`` are its entries. An entry belongs to the latest
header above it in the same file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions.text import part, part_count, strip, without
from landfall.session import materialize

# Block keys with the table each feeds and that table's columns.
BLOCKS = {
    "I94CIT & I94RES": ("I94CIT_I94RES_Code", ("I94CIT_I94RES_Code", "Country")),
    "I94PORT": ("I94Port_Code", ("I94port_Code", "City", "State")),
    "I94MODE": ("I94Mode_Code", ("I94mode_Code", "Transportation")),
    "I94ADDR": ("I94Addr_Code", ("I94addr_Code", "State")),
    "I94VISA": ("I94Visa_Code", ("I94visa_Code", "VisaType")),
}
PORT_BLOCK = "I94PORT"


def is_header(line: Column) -> Column:
    return line.contains("/*") & line.contains("-")


def is_entry(line: Column) -> Column:
    """Has ``=`` and is neither a header nor closed by ``;`` on its own line."""
    return line.contains("=") & ~line.contains(";") & ~is_header(line)


def header_key(line: Column) -> Column:
    return without(part(line, " - ", 0), "/* ")


def header_description(line: Column) -> Column:
    return without(part(line, " - ", 1), " */")


def entry_field(line: Column, index: int) -> Column:
    """Side 0 or 1 of ``=``: trimmed, quotes dropped, upper case.

    Blanks inside the quotes survive, as they are trimmed before the quotes go.
    """
    return F.upper(without(strip(part(line, "=", index)), "'"))


def parse_labels(lines: DataFrame, folder: str | None = None) -> DataFrame:
    """Lines of ``read_lines`` to entries: ``file, block_key, code, value``.

    The text is read once: headers and entries are written, to ``folder`` or to
    scratch space, and all else reads those.

    The latest header is carried down in two levels, so no file passes through
    one task: the last header of every split is carried over the splits of a
    file (one row per split), then over the lines inside a split, whose size
    the reader bounds. Lines that are neither header nor entry leave before
    the shuffle. Entries above any header are dropped.
    """
    line = F.col("line")
    order = F.struct("row", "sub")
    marked = lines.filter(is_header(line) | is_entry(line)).select(
        "file", "block", "row", "sub", "line",
        F.when(is_header(line), header_key(line)).alias("here"),
    )
    marked = materialize(lines.sparkSession, marked, "marked-lines", folder)

    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        marked.groupBy("file", "block")
        .agg(F.max_by("here", F.when(F.col("here").isNotNull(), order)).alias("latest"))
        .select(
            "file", "block",
            F.last("latest", ignorenulls=True).over(earlier).alias("inherited"),
        )
    )

    inside = Window.partitionBy("file", "block").orderBy("row", "sub").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    keyed = marked.join(carried, ["file", "block"], "left").select(
        "file",
        "line",
        F.coalesce(F.last("here", ignorenulls=True).over(inside), "inherited").alias(
            "block_key"
        ),
    )
    return keyed.filter(is_entry(line) & F.col("block_key").isNotNull()).select(
        "file",
        "block_key",
        entry_field(line, 0).alias("code"),
        entry_field(line, 1).alias("value"),
    )


def label_headers(lines: DataFrame) -> DataFrame:
    """Every block header with its description: ``file, block_key, description``."""
    line = F.col("line")
    return lines.filter(is_header(line)).select(
        "file",
        header_key(line).alias("block_key"),
        header_description(line).alias("description"),
    )


def split_ports(entries: DataFrame) -> DataFrame:
    """Add ``city`` and ``state`` from ``CITY, STATE`` values.

    A value without comma is a city without state; one with two commas or more
    is not a port and is left out.
    """
    value = F.col("value")
    return entries.filter(part_count(value, ",") <= 2).withColumns(
        {"city": strip(part(value, ",", 0)), "state": strip(part(value, ",", 1))}
    )


def label_tables(entries: DataFrame) -> dict[str, DataFrame]:
    """The five code tables, by warehouse table name.

    Each is a filter over the same entries; hand in a written table
    (``session.materialize``) so the text is parsed once. An entry that is
    repeated, in one file or in several, is one row. Two values for one code
    stay two rows, which the key check of the monthly job refuses.
    """
    tables = {}
    for key, (table, columns) in BLOCKS.items():
        rows = entries.filter(F.col("block_key") == key)
        if key == PORT_BLOCK:
            fields = split_ports(rows).select("code", "city", "state")
        else:
            fields = rows.select("code", "value")
        tables[table] = fields.distinct().toDF(*columns)
    return tables
