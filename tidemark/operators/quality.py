"""Checks that return the rows which fail; no row means the check passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count. Keys with a NULL part do not count.

    Several columns stand for the text that would join them, and are grouped as they are.
    """
    present = df.dropna(how="any", subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def suite(
    relation: str, df: DataFrame, not_nulls: Sequence[str] = (), key: Sequence[str] = (),
) -> DataFrame:
    """``(check, failures)`` for the checks of one relation, all counted in one pass.

    Rows are counted per ``key`` with map-side partial counts, so a key with very many rows
    costs no more than any other.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in not_nulls]
    per_key = df.groupBy(*key).agg(F.count("*").alias("_n"), *nulls)
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in key], F.lit(True))
    totals = {
        f"{relation}.{c} not null": F.coalesce(F.sum(f"_null_{c}"), F.lit(0)) for c in not_nulls
    }
    if key:
        totals[f"{relation}.{'|'.join(key)} unique"] = F.count_if((F.col("_n") > 1) & complete)
    counted = per_key.agg(F.array(*[
        F.struct(F.lit(name).alias("check"), total.alias("failures"))
        for name, total in totals.items()
    ]).alias("_checks"))
    return counted.select(F.inline("_checks"))
