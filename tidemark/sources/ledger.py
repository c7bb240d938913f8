"""Which files were loaded already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEDGER_COLUMNS = ("file_uri", "endpoint", "table_name", "rows_loaded", "loaded_at")
LEDGER_SCHEMA = "file_uri string, endpoint string, table_name string, rows_loaded int, loaded_at timestamp_ntz"


def new_files(candidates: DataFrame, ledger: DataFrame, name: str = "meta_file_name") -> DataFrame:
    """Files the ledger does not list."""
    seen = ledger.select(F.col("file_uri").alias(name)).distinct()
    return candidates.join(seen, name, "left_anti")


def ledger_rows(raw: DataFrame, endpoint: str, table: str, loaded_at: Column) -> DataFrame:
    """One row per loaded file, to append to the ledger once the load is committed."""
    return raw.groupBy(F.col("meta_file_name").alias("file_uri")).agg(
        F.lit(endpoint).alias("endpoint"),
        F.lit(table).alias("table_name"),
        F.count("*").cast("int").alias("rows_loaded"),
        F.first(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
    )


def recent_loads(ledger: DataFrame, k: int = 10) -> DataFrame:
    """The latest loads, newest first."""
    return ledger.orderBy(F.desc("loaded_at"), F.desc("file_uri")).limit(k)
