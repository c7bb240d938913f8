"""Comparing two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import urls as U

REPEAT_BLOCK = 65_536


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, which is dropped.

    Copies are made in two steps, so that no list grows with the number of copies.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / F.lit(REPEAT_BLOCK)))
    in_block = F.least(F.lit(REPEAT_BLOCK), F.col(times) - F.col("_block") * REPEAT_BLOCK)
    return (
        df.withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), in_block)))
        .drop(times, "_block", "_copy")
    )


def without_value(previous: DataFrame, key: str, column: str, version: str) -> DataFrame:
    """``(key, previous_<version>, _times)``: keys with rows whose ``column`` is NULL, counted."""
    missing = previous.filter(F.col(column).isNull() & F.col(key).isNotNull())
    return missing.groupBy(key, F.col(version).alias(f"previous_{version}")).agg(
        F.count("*").alias("_times")
    )


def became_non_null(
    current: DataFrame, previous: DataFrame, key: str, column: str, version: str,
) -> DataFrame:
    """Rows of ``current`` whose ``column`` is set where ``previous`` had NULL for the key.

    Adds ``previous_<version>``. A row appears once per matching previous row, as in a join; the
    previous side is counted per key first, so its duplicates are not shuffled.
    """
    before = without_value(previous, key, column, version)
    matched = current.filter(F.col(column).isNotNull()).join(before, key)
    return repeat_rows(matched, "_times").select(*current.columns, f"previous_{version}")


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """``key NOT IN (SELECT other_key FROM other)`` with SQL's treatment of NULL, for any size.

    Nothing is left if ``other`` holds a NULL; a NULL key is left only if ``other`` is empty.
    """
    values = other.select(F.col(other_key or key).alias("_value"))
    facts = values.agg(F.struct(
        (F.count("*") > F.count("_value")).alias("has_null"), (F.count("*") == 0).alias("is_empty")
    )).scalar()
    missing = df.join(values.distinct(), F.col(key) == F.col("_value"), "left_anti")
    return missing.filter(~facts["has_null"] & (F.col(key).isNotNull() | facts["is_empty"]))


def new_keys(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose keys ``previous`` does not hold; a NULL never matches."""
    return current.join(previous.select(*keys).distinct(), list(keys), "left_anti")


def tagged(df: DataFrame, change_type: str, version: str) -> DataFrame:
    """Add the constant tag, and a typed NULL where there is no previous version."""
    previous = f"previous_{version}"
    if previous not in df.columns:
        df = df.withColumn(previous, F.lit(None).cast(df.schema[version].dataType))
    return df.withColumn("change_type", F.lit(change_type))


def is_current(url: Column) -> Column:
    """Whether the fourth part of an address says that the results are still coming in."""
    return U.path_segment(url, 4) == "current"
