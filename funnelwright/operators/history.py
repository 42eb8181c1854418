"""Order in time: the latest state of a key, what changed, and the row of another table that is next in time.

A key that holds a large share of the rows must not have all of them in one task. So a key's rows are cut into slices of time,
each of which is a window of its own; what a slice needs to know of those before it is the last row of the nearest one, which
a second, small window over slices carries over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelwright.functions import quoted
from funnelwright.operators.joins import left_join
from funnelwright.operators.union import union_all_by_name

# Days of a slice. Of one key, so many days' rows come together in a task.
SLICE_DAYS = 30

_DAY = 86_400_000_000


def latest_state(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each combination of ``keys`` by the ``order`` columns, ties by the other columns from left to right.

    NULL comes before all values, in ``keys`` it is a value like others. A maximum, so a key's rows collapse to one per task
    before they are shuffled, however many it has. Columns keep their order.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    values = [*order, *rest]
    last = df.groupBy(*[quoted(name) for name in keys]).agg(F.max(F.struct(*[quoted(name) for name in values])).alias("_last"))
    return last.select([quoted(name) if name in keys else F.col("_last")[name].alias(name) for name in df.columns])


def previous_values(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], values: Sequence[str], prefix: str = "previous_", slice_days: int = SLICE_DAYS
) -> DataFrame:
    """``df`` with the ``values`` of the row before, of the same ``keys`` in the order of ``time`` and then the ``order`` columns.

    ``time`` is a date or a timestamp; a NULL comes first. The first row of a key has NULLs in the new columns, and ``prefix`` + "row"
    says whether there is a row before. Rows of a key that agree in ``time`` and ``order`` must be equal in ``values`` too, or the
    order among them is open.
    """
    ordered = [time, *order]
    sliced = df.withColumns({"_slice": _slice(F.col(time), slice_days), "_entry": F.struct(*[quoted(name) for name in values])})
    place = F.struct(*[quoted(name).alias(f"o{n}") for n, name in enumerate(ordered)], F.col("_entry"))
    ends = sliced.groupBy(*keys, "_slice").agg(F.max(place)["_entry"].alias("_end"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    carried = ends.select(*keys, "_slice", F.lag("_end").over(by_slice).alias("_entry")).filter("_entry IS NOT NULL")

    # What is carried into a slice is a row before its first one. So the rows move once, for one window.
    both = union_all_by_name([sliced.withColumn("_own", F.lit(True)), carried.withColumn("_own", F.lit(False))])
    within = Window.partitionBy(*keys, "_slice").orderBy("_own", *[F.asc_nulls_first(name) for name in ordered])
    found = both.withColumn("_before", F.lag("_entry").over(within)).filter("_own")
    new = [F.col("_before")[name].alias(f"{prefix}{name}") for name in values]
    return found.select(*[quoted(name) for name in df.columns], *new, F.col("_before").isNotNull().alias(f"{prefix}row"))


def status_changes(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], status: str, slice_days: int = SLICE_DAYS
) -> DataFrame:
    """The rows at which ``status`` differs from that of the row before, with ``previous_<status>``; a key's first row is one of them.

    NULL is a status like others.
    """
    known = previous_values(df, keys, time, order, [status], slice_days=slice_days)
    changed = ~F.col("previous_row") | ~quoted(status).eqNullSafe(quoted(f"previous_{status}"))
    return known.filter(changed).drop("previous_row")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    direction: str = "next",
    ties: Sequence[str] = (),
    heavy: DataFrame | None = None,
    slice_days: int = SLICE_DAYS,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Each row of ``left`` with the one row of ``right`` with equal ``on`` columns that is nearest in time.

    ``direction`` is "next", the first right row at or after the left row's time, or "last", the last one at or before it. Of right rows
    with equal keys and times, the smallest in ``ties`` (then in the other columns, from left to right) is taken; NULL is smallest.
    Left rows without such a row, or with a NULL in key or time, stay with NULLs. Right rows with a NULL there match nothing. Names
    of columns other than ``on`` must differ between the sides; both times are of one type, dates or timestamps.

    The search runs over distinct (key, time) of the left side, with the right side merged in by time: per key and slice of time a
    window, and per key a window over the slices that carries the nearest right row into slices that have none. Then left
    rows are joined with what was found for their key and time; ``heavy`` are the heavy keys of that join, ``on`` and
    ``left_time``, for times of a key that have very many left rows. See :func:`asked_times`.

    ``crowded``, the :func:`heavy_keys` of both sides on ``on``, says which keys need all this, each once; by default every key does.
    The rows of a key that is not listed are few: they move once, into one window.
    """
    if direction not in ("next", "last"):
        raise ValueError(f"no such direction: {direction}")
    if crowded is not None:
        key = _present([*on, left_time])
        keyed = left.filter(key)
        many = [of_crowded_keys(side, crowded, on) for side in (keyed, right)]
        few = [without_crowded_keys(side, crowded, on) for side in (keyed, right)]
        dealt = as_of_join(*many, on, left_time, right_time, direction, ties, heavy, slice_days)
        return union_all_by_name([dealt, _as_of_in_one_window(*few, on, left_time, right_time, direction, ties), left.filter(~key)])
    rest = [name for name in right.columns if name not in on and name != right_time]
    order = [*ties, *[name for name in rest if name not in ties]]
    found = F.struct(F.col("_time"), *[quoted(name) for name in order]) if order else F.struct("_time")
    offered = right.filter(_present([*on, right_time])).withColumn("_time", F.col(right_time))
    offered = offered.groupBy(*on, "_time").agg(F.min(found).alias("_found"))
    asked = asked_times(left, on, left_time).withColumnRenamed(left_time, "_time")

    nearest, sign = (F.min, F.desc) if direction == "next" else (F.max, F.asc)
    both = union_all_by_name([asked.withColumn("_asked", F.lit(True)), offered.withColumn("_asked", F.lit(False))])
    both = both.withColumn("_slice", _slice(F.col("_time"), slice_days))
    # In a slice: right rows from the first (or last) time on, the right rows of a time before its left row.
    in_slice = Window.partitionBy(*on, "_slice").orderBy(sign("_time"), F.asc("_asked")).rowsBetween(Window.unboundedPreceding, 0)
    # Between slices: the nearest right row of the slices that follow (or precede).
    by_slice = Window.partitionBy(*on).orderBy(sign("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    edges = both.groupBy(*on, "_slice").agg(nearest("_found").alias("_edge"))
    carried = edges.select(*on, "_slice", F.last("_edge", True).over(by_slice).alias("_carried")).filter("_carried IS NOT NULL")

    answers = both.join(carried, [*on, "_slice"], "left").withColumn("_own", F.last("_found", True).over(in_slice)).filter("_asked")
    answers = answers.select(*on, F.col("_time").alias(left_time), F.coalesce("_own", "_carried").alias("_found")).filter("_found IS NOT NULL")
    joined = left_join(left, answers, [*on, left_time], heavy)
    taken = {right_time: F.col("_found._time")} | {name: F.col("_found")[name] for name in rest}
    return joined.select(*[quoted(name) for name in left.columns], *[taken[name].alias(name) for name in right.columns if name not in on])


def of_crowded_keys(df: DataFrame, crowded: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of the keys in ``crowded``."""
    return df.join(crowded.select(*on), list(on), "left_semi")


def without_crowded_keys(df: DataFrame, crowded: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of all other keys."""
    return df.join(crowded.select(*on), list(on), "left_anti")


def _as_of_in_one_window(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, direction: str, ties: Sequence[str]
) -> DataFrame:
    """:func:`as_of_join` with all rows of a key, of both sides, in one window; ``left`` has no NULL in key or time."""
    rest = [name for name in right.columns if name not in on and name != right_time]
    order = [*ties, *[name for name in rest if name not in ties]]
    own = [name for name in left.columns if name not in on and name != left_time]
    asked = left.select(*on, F.col(left_time).alias("_time"), F.struct(F.lit(True).alias("_asked"), *[quoted(name) for name in own]).alias("_row"))
    found = F.struct(F.col(right_time).alias("_time"), *[quoted(name) for name in order])
    offered = right.filter(_present([*on, right_time])).select(*on, F.col(right_time).alias("_time"), found.alias("_found"))
    # Right rows come before left rows of their time, the smallest of them last.
    sign = F.desc if direction == "next" else F.asc
    so_far = Window.partitionBy(*on).orderBy(sign("_time"), F.col("_row").isNotNull(), F.desc("_found")).rowsBetween(Window.unboundedPreceding, 0)
    both = union_all_by_name([asked, offered]).withColumn("_nearest", F.last("_found", True).over(so_far)).filter("_row IS NOT NULL")
    mine = {left_time: F.col("_time")} | {name: F.col("_row")[name] for name in own}
    taken = {right_time: F.col("_nearest._time")} | {name: F.col("_nearest")[name] for name in rest}
    of_left = [quoted(name) if name in on else mine[name].alias(name) for name in left.columns]
    return both.select(*of_left, *[taken[name].alias(name) for name in right.columns if name not in on])


def asked_times(left: DataFrame, on: Sequence[str], left_time: str) -> DataFrame:
    """The distinct keys and times of ``left``; what the left rows of :func:`as_of_join` are joined with in the end."""
    return left.filter(_present([*on, left_time])).select(*on, left_time).distinct()


def _slice(time: Column, days: int) -> Column:
    """Number of the slice that a date or timestamp is in; NULL is in a slice before all."""
    since = F.unix_micros(time.cast("timestamp"))
    return F.coalesce(F.floor(since / F.lit(days * _DAY)).cast("int"), F.lit(-(2**31)))


def _present(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])
