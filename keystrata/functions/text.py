"""Text functions of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_substring(text: Column, search: Column | str) -> Column:
    """Non-overlapping occurrences by byte length; an empty or NULL search gives NULL."""
    if isinstance(search, str):
        search = F.lit(search)
    removed = F.octet_length(text) - F.octet_length(F.replace(text, search, F.lit("")))
    width = F.octet_length(search)
    return F.when(width > 0, F.floor(removed / width)).cast("int")


def too_long(column: Column, limit: int) -> Column:
    return F.length(column) > limit


# Characters that arrive behind a stray backslash.
ESCAPED_CHARACTERS = ("¿", "¡", ",")


def unescape(column: Column) -> Column:
    for char in ESCAPED_CHARACTERS:
        column = F.replace(column, F.lit("\\" + char), F.lit(char))
    return column
