"""Data-quality profiles of the conformed tables. Each is one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import quoted

HASHES = ("email_hash", "phone_hash")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in each column."""
    return df.agg(*[F.count_if(quoted(name).isNull()).alias(name) for name in df.columns])


def null_percentages(df: DataFrame) -> DataFrame:
    """One row: the percentage of NULLs in each column; NULL for an empty table."""
    rows = F.count("*")
    return df.agg(
        *[(F.try_divide(F.count_if(quoted(name).isNull()), rows) * 100).alias(name) for name in df.columns]
    )


def key_audit(leads: DataFrame, keys: Sequence[str] = HASHES, entity: str = "lead_uuid") -> DataFrame:
    """Per key: distinct and total entities, rows, and rows without an entity. A sound key has one entity."""
    return leads.groupBy(*keys).agg(
        F.count_distinct(entity).alias(f"unique_{entity}s"),
        F.count("*").alias("total_rows"),
        F.count_if(F.col(entity).isNull()).alias(f"null_{entity}_count"),
        F.count(entity).alias(f"non_null_{entity}_count"),
    )


def key_multiplicity(reports: DataFrame, keys: Sequence[str] = HASHES, value: str = "lead_number") -> DataFrame:
    """One row: how many keys have more than one non-NULL value, repeats counted."""
    per_key = reports.groupBy(*keys).agg(F.count(value).alias("n_values"))
    return per_key.filter("n_values > 1").agg(F.count("*").alias("n_keys"))
