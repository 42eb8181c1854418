"""Ratio of two counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals; 0 when there is nothing to divide by."""
    return F.coalesce(F.round(F.try_divide(part, whole) * 100, 2), F.lit(0.0))
