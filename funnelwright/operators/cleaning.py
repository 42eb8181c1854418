"""Cleaning of raw rows and conforming them to a table specification."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import (
    collapse_whitespace,
    parse_boolean,
    parse_date,
    parse_integer,
    parse_string,
    parse_timestamp,
    quoted,
)
from funnelwright.specs import Field, TableSpec

_SPARK_TYPES = {"date": "date", "timestamp": "timestamp", "integer": "int", "boolean": "boolean"}


def normalise_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Collapse whitespace in every column, which also turns every column into a string."""
    return df.select(
        [quoted(name) if name in keep else collapse_whitespace(quoted(name)).alias(name) for name in df.columns]
    )


def clean(df: DataFrame, source: str | Sequence[str] | None = None) -> DataFrame:
    """Collapse whitespace, drop copies of rows, drop rows that are NULL throughout.

    ``source`` names a column with the origin of each row, or several. Rows are copies only within one origin, and the
    columns themselves are neither cleaned nor counted when looking for NULL rows.

    Spark combines copies before the one shuffle, whose key is the whole row: a row repeated many times arrives
    at most once per map task.
    """
    keep = [] if source is None else [source] if isinstance(source, str) else list(source)
    raw = [name for name in df.columns if name not in keep]
    normalised = normalise_text(df, keep)
    distinct = normalised.groupBy(*[quoted(name) for name in df.columns])
    # The test for NULL rows is an aggregate, not a filter on the columns: from a predicate over n columns Catalyst
    # derives up to 2^n constraints once these columns are renamed or retyped, and planning a later join never ends.
    has_value = F.bool_or(F.coalesce(*[quoted(name) for name in raw]).isNotNull())
    return distinct.agg(has_value.alias("_has_value")).filter("_has_value").drop("_has_value")


def null_sentinels(df: DataFrame, columns: Iterable[str], sentinels: Sequence[str]) -> DataFrame:
    """Replace filler values in the named columns by NULL, in one projection."""
    targets = set(columns)
    unknown = targets.difference(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(
        [
            F.when(~quoted(name).isin(*sentinels), quoted(name)).alias(name) if name in targets else quoted(name)
            for name in df.columns
        ]
    )


def project_to_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep the spec's columns in the order of ``df`` and give them their final names; no typing."""
    targets = _targets(df, spec)
    return df.select([quoted(name).alias(targets[name][1]) for name in df.columns if name in targets])


def conform(df: DataFrame, spec: TableSpec, invalid: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Type the spec's columns, keep only those and give them their final names, in the order of ``df``; those of ``keep`` follow.

    Text that does not fit its type becomes NULL. Columns of the spec that ``df`` lacks are skipped. ``invalid``
    names an extra column for what was lost: an array of (column_name, raw_value), NULL in rows without losses.
    Stored with the table it lets :func:`count_invalid` list all invalid values without another pass over the
    raw files.
    """
    targets = _targets(df, spec)
    kept = [name for name in df.columns if name in targets]
    types = dict(df.dtypes)
    typed = [_typed(quoted(name), targets[name][0], types[name]).alias(targets[name][1]) for name in kept]
    kept_too = [quoted(name) for name in keep]
    if invalid is None:
        return df.select(*typed, *kept_too)

    # Two projections, so that each value is parsed once: the second only compares parsed with raw.
    checked = [name for name in kept if _can_fail(targets[name][0])]
    raws = [quoted(name).cast("string").alias(f"_raw_{i}") for i, name in enumerate(checked)]
    lost = [F.col(f"_raw_{i}").isNotNull() & F.col(targets[name][1]).isNull() for i, name in enumerate(checked)]
    entries = [
        F.when(gone, F.struct(F.lit(name).alias("column_name"), F.col(f"_raw_{i}").alias("raw_value")))
        for i, (name, gone) in enumerate(zip(checked, lost, strict=True))
    ]
    nothing = F.lit(None).cast("array<struct<column_name:string,raw_value:string>>")
    any_lost = F.lit(False)
    for gone in lost:
        any_lost = any_lost | gone
    losses = F.when(any_lost, F.array_compact(F.array(*entries))) if entries else nothing
    return df.select(*typed, *kept_too, *raws).select(*[targets[name][1] for name in kept], *kept_too, losses.alias(invalid))


def count_invalid(df: DataFrame, invalid: str) -> DataFrame:
    """(column_name, raw_value, n_rows) from the losses that :func:`conform` recorded in column ``invalid``."""
    # explode_outer, because a plain explode would have Spark evaluate the parsing again in a derived filter.
    return (
        df.select(F.explode_outer(invalid).alias("loss"))
        .filter("loss is not null")
        .groupBy(F.col("loss.column_name").alias("column_name"), F.col("loss.raw_value").alias("raw_value"))
        .agg(F.count("*").alias("n_rows"))
    )


def invalid_values(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every raw value that does not fit its column's type, with the number of rows it occurs in.

    One pass for all columns; the result stays distributed.
    """
    return count_invalid(conform(df, spec, invalid="_invalid"), "_invalid")


def _targets(df: DataFrame, spec: TableSpec) -> dict[str, tuple[Field, str]]:
    found = {}
    for field in spec.fields:
        source = field.source_in(df.columns)
        if source is not None:
            found[source] = (field, field.target_for(source))
    return found


def _typed(column: Column, field: Field, current_type: str) -> Column:
    if current_type == _SPARK_TYPES.get(field.type):
        return column
    text = column.cast("string")
    if field.type == "date":
        return parse_date(text, field.format)
    if field.type == "timestamp":
        return parse_timestamp(text, field.format)
    if field.type == "integer":
        return parse_integer(text, field.format)
    if field.type == "boolean":
        return parse_boolean(text)
    return parse_string(text, field.format)


def _can_fail(field: Field) -> bool:
    return field.type in _SPARK_TYPES or field.format is not None
