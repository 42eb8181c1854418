"""Text normalisation and column naming."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column of exactly this name; raw headers may hold dots, spaces and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def collapse_whitespace(column: Column) -> Column:
    """Runs of ASCII whitespace become one space and the ends are trimmed.

    Non-string input is rendered as string first. Blank text becomes ``''``, not NULL.
    """
    # The characters of \s one by one: as a class they are a table to look up, which takes less time per character.
    return F.trim(F.regexp_replace(column.cast("string"), r"[\t\n\x0B\f\r ]+", " "))


def snake_case(name: str) -> str:
    """``Appt Date`` -> ``appt_date``. Works on column names, never on data."""
    # Fixed rule of names: a run of anything but ASCII letters and digits is one underscore.
    return re.sub(r"[^a-zA-Z0-9]+", "_", name.strip()).lower()
