"""Counts over documents and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.documents import document_id, record_count


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def records_per_document(raw: DataFrame) -> DataFrame:
    """One row per document; the records of its parts are summed."""
    return raw.groupBy(document_id().alias("document"), "meta_file_modified").agg(
        F.sum(record_count()).cast("bigint").alias("n_records")
    )


def count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def run_summary(matches: DataFrame, unit: list[str]) -> DataFrame:
    """One row: how many units had any match, and how many matches they had."""
    per_unit = matches.groupBy(*unit).agg(F.count("*").alias("matches"))
    return per_unit.agg(
        F.count("*").alias("units"),
        F.coalesce(F.sum("matches"), F.lit(0)).alias("matches"),
    )
