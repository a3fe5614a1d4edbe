"""Text helpers shared by the label extraction and the demography rollups."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# What counts as white space, and what ends a line besides the
# line feed and carriage return that the text reader itself splits on.
WHITE_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
EXTRA_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, rf"^{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")


def part(text: Column, separator: str, index: int) -> Column:
    """The n-th piece (from 0) between literal separators, NULL if absent."""
    return F.get(F.split(text, re.escape(separator)), index)


def part_count(text: Column, separator: str) -> Column:
    return F.size(F.split(text, re.escape(separator)))


def without(text: Column, literal: str) -> Column:
    """Delete every occurrence of a literal."""
    return F.replace(text, F.lit(literal), F.lit(""))


def joined_set(values: Column, separator: str) -> Column:
    """A set of strings as one string, in sorted order so re-runs agree."""
    return F.array_join(F.array_sort(values), separator)
