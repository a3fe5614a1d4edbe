"""Column-to-column functions."""

from landfall.functions.dates import (
    day_number_to_date,
    day_number_to_text,
    mdy_to_date,
    mdy_to_text,
    month_tag,
)
from landfall.functions.numbers import load_cast, to_numeric, too_long
from landfall.functions.text import joined_set, part, part_count, strip, without

__all__ = [
    "day_number_to_date",
    "day_number_to_text",
    "joined_set",
    "load_cast",
    "mdy_to_date",
    "mdy_to_text",
    "month_tag",
    "part",
    "part_count",
    "strip",
    "to_numeric",
    "too_long",
    "without",
]
