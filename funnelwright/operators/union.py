"""Union of frames with different columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_all_by_name(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """All rows of all frames, matched by column name; a column that a frame lacks is NULL in its rows.

    None entries are skipped; None if nothing is left. Columns of one name must agree in type, so conform first.
    """
    present = [frame for frame in frames if frame is not None]
    if not present:
        return None
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), present)
