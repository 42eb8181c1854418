"""Tables as multisets: what one has and the other has not, counting copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import quoted
from funnelwright.operators.union import union_all_by_name

# Copies of a row that are made from one array.
_AT_ONCE = 100_000


def copies(old: DataFrame, new: DataFrame, counts: tuple[str, str] = ("n_old", "n_new")) -> DataFrame:
    """The distinct rows of both tables with two more columns: how often the first has them, and how often the second.

    Columns are matched by name, and both tables have the same; NULL equals NULL. One shuffle, whose key is the whole row; a row
    is counted in each task first, so copies of it, however many, are a row per task.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    sides = [side.withColumns({name: F.lit(int(at == own)) for own, name in enumerate(counts)}) for at, side in enumerate((old, new))]
    grouped = union_all_by_name(sides).groupBy(*[quoted(name) for name in old.columns])
    return grouped.agg(*[F.sum(name).alias(name) for name in counts])


def added(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` EXCEPT ALL ``old``: rows as many times as the second table has more of them."""
    return _repeated(old, new, F.col("_new") - F.col("_old"))


def removed(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` EXCEPT ALL ``new``."""
    return _repeated(old, new, F.col("_old") - F.col("_new"))


def kept(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` INTERSECT ALL ``new``: rows as many times as both tables have them."""
    return _repeated(old, new, F.least("_old", "_new"))


def _repeated(old: DataFrame, new: DataFrame, times: Column) -> DataFrame:
    counted = copies(old, new, ("_old", "_new")).withColumn("_times", times).filter("_times > 0")
    # In two steps, as a row may be there more often than an array should be long.
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / _AT_ONCE))))
    own = F.least(F.lit(_AT_ONCE), F.col("_times") - F.col("_block") * _AT_ONCE)
    rows = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), own)))
    return rows.select(*[quoted(name) for name in old.columns])
