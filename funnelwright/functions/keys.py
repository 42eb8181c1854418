"""Deterministic keys: name-based UUIDs (version 5) computed by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelwright.functions.text import quoted

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"

_PLAIN_TEXT = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.DecimalType)


def key_text(df: DataFrame, name: str) -> Column:
    """The text by which a value enters a key: as Python's ``str`` prints it, NULL for NULL."""
    column = quoted(name)
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole_second = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        with_micros = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.when(with_micros.endswith(".000000"), whole_second).otherwise(with_micros)
    if isinstance(kind, _PLAIN_TEXT):
        return column.cast("string")
    raise TypeError(f"column {name!r} of type {kind.simpleString()} has no agreed text form for a key")


def uuid5(text: Column) -> Column:
    """Version 5 UUID of ``text`` in the DNS namespace, NULL for NULL."""
    # Cut and joined as bytes: in a string each piece would be looked for character by character from the start.
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), text.cast("binary"))).cast("binary")
    # Digit 13 becomes the version. The top bits of digit 17 become 10, which leaves one of 8, 9, a, b.
    variant = F.translate(F.substring(digest, 17, 1).cast("string"), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        _bytes("-"),
        F.substring(digest, 9, 4),
        _bytes("-5"),
        F.substring(digest, 14, 3),
        _bytes("-"),
        variant.cast("binary"),
        F.substring(digest, 18, 3),
        _bytes("-"),
        F.substring(digest, 21, 12),
    ).cast("string")


def _bytes(text: str) -> Column:
    return F.lit(text).cast("binary")


def deterministic_uuid(df: DataFrame, *names: str, sep: str = "") -> Column:
    """UUID of the named columns' texts, joined by ``sep``, NULLs left out.

    With the default empty ``sep`` different rows can share a key: ('ab', 'c'), ('a', 'bc') and ('ab', NULL,
    'c') do, and so do NULL and ''. That is the established key; pass a ``sep`` to tell the first two apart.
    """
    return uuid5(F.concat_ws(sep, *[key_text(df, name) for name in names]))
