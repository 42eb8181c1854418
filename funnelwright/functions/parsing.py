"""Parsing of raw text into typed columns.

A value that does not parse becomes NULL, also under ANSI mode, so no session setting is needed. NULL input
gives NULL throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of booleans, compared in lower case.
TRUE_WORDS = ("true", "1")
FALSE_WORDS = ("false", "0")

# A number with a decimal point, as a lenient integer cast accepts it: '1.5', '1.', '.5', '-.5' and '.'.
_DECIMAL_POINT_NUMBER = r"^[\s\p{Cntrl}]*[+-]?[0-9]*[.][0-9]*[\s\p{Cntrl}]*$"


def parse_date(column: Column, pattern: str | None = None) -> Column:
    return F.try_to_date(column, pattern) if pattern else column.try_cast("date")


def parse_timestamp(column: Column, pattern: str | None = None) -> Column:
    return F.try_to_timestamp(column, F.lit(pattern)) if pattern else column.try_cast("timestamp")


def parse_integer(column: Column, pattern: str | None = None) -> Column:
    """32-bit integer; a decimal part is cut off, overflow gives NULL.

    ``pattern`` is a regular expression that must be found somewhere in the text.
    """
    # try_cast takes whole numbers. Only what it refuses pays for the regular expressions; the '0' put after
    # the sign gives '.5' a digit to read.
    before_point = F.substring_index(column, ".", 1)
    whole_part = F.regexp_replace(before_point, r"^[\s\p{Cntrl}]*([+-]?)", "$10")
    truncated = F.when(column.rlike(_DECIMAL_POINT_NUMBER), whole_part.try_cast("int"))
    number = F.coalesce(column.try_cast("int"), truncated)
    return F.when(column.rlike(pattern), number) if pattern else number


def parse_boolean(column: Column) -> Column:
    word = F.lower(column)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def parse_string(column: Column, pattern: str | None = None) -> Column:
    return F.when(column.rlike(pattern), column) if pattern else column
