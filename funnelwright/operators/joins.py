"""Joins that stay balanced when one key holds a large share of the rows: left, full outer, and what matches nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import quoted
from funnelwright.operators.union import union_all_by_name

# Rows of one key that a task joins without trouble; a key with more of them on a side is cut into slices of so many.
LEAST_ROWS = 1_000_000
# In how many parts the rows of a key are dealt to find out whether it is heavy, where the list is too long to broadcast.
_PARTS = 16
# How often the rows of a key with many rows on both sides are repeated on average, at most, to meet the slices of the other side.
_REPEATS = 16

_SLICES = ("_left_slices", "_right_slices")


def heavy_keys(
    left: DataFrame, right: DataFrame, on: Sequence[str], least_rows: int = LEAST_ROWS, left_rows: str | None = None
) -> DataFrame:
    """Keys with at least ``least_rows`` rows on a side, and in how many slices to cut their rows on either side.

    Exact counts, whatever the number or share of such keys: there are at most as many as ``least_rows`` goes into the
    rows. ``left_rows`` names a column of ``left`` that says how many rows each row stands for. Each side is counted once, and
    combined per task before it is shuffled, so a key's frequency does not matter. :func:`left_join` reads the result several
    times: store it first.

    A slice has ``least_rows`` rows, and more for a key with so many rows on both sides that slices of that size would repeat each
    of its rows more than ``_REPEATS`` times on average: what moves stays in proportion to the rows, though their pairs do not.
    """
    n_left = F.count(F.lit(1)) if left_rows is None else F.sum(left_rows)
    sides = [(left, {"_left_rows": n_left}), (right, {"_right_rows": F.count(F.lit(1))})]
    return slices_of(crowds(sides, on, least_rows), on, "_left_rows", "_right_rows", least_rows)


def crowds(sides: Sequence[tuple[DataFrame, Mapping[str, Column]]], on: Sequence[str], least_rows: int = LEAST_ROWS) -> DataFrame:
    """Keys of which a side has at least ``least_rows`` rows by one of its counts, with these counts.

    Each side comes with its counts by name, and is counted once. For several joins of the same sides, store this and make the heavy
    keys of each with :func:`slices_of`. Counts of a side that has less of a key by all of them are NULL.
    """
    by_side = []
    for df, counts in sides:
        counted = df.filter(_all_present(on)).groupBy(*on).agg(*[count.alias(name) for name, count in counts.items()])
        by_side.append(counted.filter(reduce(or_, [F.col(name) >= least_rows for name in counts])))
    names = [name for _, counts in sides for name in counts]
    return union_all_by_name(by_side).groupBy(*on).agg(*[F.max(name).alias(name) for name in names])


def slices_of(crowded: DataFrame, on: Sequence[str], left_rows: str, right_rows: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The :func:`heavy_keys` of two sides from two columns of their :func:`crowds`."""
    many = [F.when(F.col(name) >= least_rows, F.col(name)) for name in (left_rows, right_rows)]
    n, m = (F.coalesce(rows, F.lit(1)).cast("double") for rows in many)
    # n rows in n/s slices and m rows in m/s: 2nm/s rows move, which are to be at most _REPEATS * (n + m).
    slice_rows = F.greatest(F.lit(float(least_rows)), 2 * n * m / (_REPEATS * (n + m)))
    slices = [F.ceil(own / slice_rows).cast("int").alias(name) for own, name in zip((n, m), _SLICES, strict=True)]
    return crowded.filter(F.coalesce(*many).isNotNull()).select(*on, *slices)


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    heavy: DataFrame | None = None,
    slice_by: Sequence[str] = (),
    required: Sequence[str] = (),
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on equal ``on`` columns, which appear once. NULL never equals NULL.

    Left rows with a NULL in a ``required`` column match nothing either.

    Two things would put a large part of the rows into one task:

    * Left rows with a NULL in the key all hash alike, and match nothing. They skip the join and its shuffle.
    * The keys in ``heavy``, see :func:`heavy_keys`, hold many rows on one side or both. Each is joined as a grid of
      slices. Adaptive execution splits partitions too, but only those of the left side of a left
      join, and it goes by compressed size: the copies of a row that snapshots bring compress to almost nothing.

    ``slice_by`` names right columns that tell rows of one key apart. Left rows are dealt to slices by their content and the input
    partition they are in, so only copies of one row within one partition stay together. The result is the same with and without
    ``heavy``, whatever keys it lists, each once.
    """
    matchable = _all_present([*on, *required])
    keyed, keyless = left.filter(matchable), left.filter(~matchable)
    if heavy is None:
        joined = keyed.join(right, list(on), "left")
    else:
        joined = _grid_join(keyed, right, on, heavy, _content(right, slice_by))
    if not any(left.schema[name].nullable for name in (*on, *required)):
        return joined
    return union_all_by_name([joined, keyless])


def full_outer_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], heavy: DataFrame | None = None, marks: Sequence[str] = ("in_left", "in_right")
) -> DataFrame:
    """All pairs of rows with equal ``on`` columns, and the rows of either side that match nothing, with NULLs for the other side.

    The ``on`` columns appear once. NULL never equals NULL. ``marks`` names two new columns that say whether a row has a left and a
    right row in it. Names of other columns must differ between the sides. Keys in ``heavy``, see :func:`heavy_keys`, are
    joined as grids. Rows with a NULL in the key skip the join.

    A left join of the right rows, and the left rows that match nothing: a full join of Spark's makes all pairs of a key, or of a
    cell of its grid, before it passes the first one on, and so holds a product in a task's memory. The left rows move twice, so
    ``left`` should be the smaller side.
    """
    in_left, in_right = marks
    turned = None if heavy is None else heavy.select(*on, *[F.col(name).alias(other) for name, other in zip(_SLICES, _SLICES[::-1], strict=True)])
    marked = left.withColumn(in_left, F.lit(True))
    joined = left_join(right.withColumn(in_right, F.lit(True)), marked, on, turned)
    joined = joined.withColumn(in_left, F.coalesce(in_left, F.lit(False)))
    alone = unmatched(marked, right, on, heavy).withColumn(in_right, F.lit(False))
    names = [*on, *[name for name in marked.columns if name not in on], *[name for name in right.columns if name not in on], in_right]
    return union_all_by_name([joined, alone]).select([quoted(name) for name in names])


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str], heavy: DataFrame | None = None) -> DataFrame:
    """The rows of ``left`` whose ``on`` columns equal those of no row of ``right``; rows with a NULL there are among them.

    Only the distinct keys of ``right`` are needed. Those of the keys in ``heavy`` are repeated for every slice of their left rows, so
    that no task gets all left rows of a key.
    """
    key = _all_present(on)
    keys = right.filter(key).select(*on).distinct()
    keyed, keyless = left.filter(key), left.filter(~key)
    if heavy is None:
        found = keyed.join(keys, list(on), "left_anti")
    else:
        slices = heavy.select(*on, "_left_slices")
        repeated = keys.join(slices, list(on), "left").withColumn("_row", _each(F.col("_left_slices"), F.col("_left_slices").isNotNull()))
        dealt = _flagged(keyed.withColumn("_from", _content(keyed, placed=True)), slices, on, F.col("_from"))
        dealt = dealt.withColumn("_row", _slice_of(F.col("_from"), F.col("_left_slices")))
        found = dealt.join(repeated, [*on, "_row"], "left_anti").drop("_row", "_from", "_left_slices")
    return union_all_by_name([found, keyless])


def _content(df: DataFrame, names: Sequence[str] = (), placed: bool = False) -> Column:
    """A hash of the named columns, of all if none is named; with ``placed``, of the input partition too.

    Neither changes when a lost task runs again, so rows go where they went before.
    """
    return F.xxhash64(*([F.spark_partition_id()] if placed else []), *[quoted(name) for name in names or df.columns])


def _slice_of(content: Column, slices: Column) -> Column:
    return F.when(slices.isNotNull(), F.pmod(content, slices).cast("int")).otherwise(F.lit(0))


def _grid_join(left: DataFrame, right: DataFrame, on: Sequence[str], heavy: DataFrame, content_of_right: Column) -> DataFrame:
    """Left join in which each heavy key is a grid: a left row is in one row of it, a right row in one column.

    Each pair meets in one cell, as either side is repeated for every slice of the other. Other keys are one cell.

    A row is repeated only for keys that the other side has. It then has a match in some cell, and what it does not match in the
    others is dropped; a row that is there once and matches nothing has no match at all. So no second join tells which rows
    have been matched.
    """
    rows, columns = F.col("_left_slices"), F.col("_right_slices")
    of_left = heavy.join(_present_keys(right, heavy.filter(columns > 1), on, "_right_present"), list(on), "left")
    by_row = (
        _flagged(left.withColumn("_from", _content(left, placed=True)), of_left, on, F.col("_from"))
        .withColumn("_row", _slice_of(F.col("_from"), rows))
        .withColumn("_column", _each(columns, F.col("_right_present")))
        .drop("_from", *_SLICES)
    )
    by_column = (
        _flagged(right.withColumn("_from", content_of_right), heavy, on, F.col("_from"))
        .withColumn("_column", _slice_of(F.col("_from"), columns))
        .withColumn("_row", _each(rows, rows.isNotNull()))
        .withColumn("_in_right", F.lit(True))
        .drop("_from", *_SLICES)
    )
    joined = by_row.join(by_column, [*on, "_row", "_column"], "left")
    kept = F.col("_right_present").isNull() | F.col("_in_right")
    return joined.filter(kept).drop("_row", "_column", "_right_present", "_in_right")


def _present_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], mark: str) -> DataFrame:
    """Those of the keys that ``df`` has, marked in a new column."""
    return df.join(keys, list(on), "left_semi").select(*on).distinct().withColumn(mark, F.lit(True))


def _flagged(df: DataFrame, flags: DataFrame, on: Sequence[str], part: Column) -> DataFrame:
    """``df`` with the flags of its keys; NULL where a key has none.

    No broadcast is forced: Spark broadcasts the flags while their size allows. Beyond that the join shuffles ``df``; so that
    no task gets all rows of a key, each key's rows are in ``_PARTS`` parts, and its flags are repeated for each.
    """
    repeated = flags.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
    return df.withColumn("_part", F.pmod(part, F.lit(_PARTS)).cast("int")).join(repeated, [*on, "_part"], "left").drop("_part")


def _each(slices: Column, condition: Column) -> Column:
    """One row per slice where the condition holds, and one row otherwise."""
    return F.explode(F.when(condition, F.sequence(F.lit(0), slices - 1)).otherwise(F.array(F.lit(0))))


def _all_present(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])
