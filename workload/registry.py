"""Registered queries and the SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Site that relative addresses of the derived pages belong to.
ROOT = "https://www.example.org"
DATA_ROOT = "https://data.example.org/stats"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_of(ts: str | Column) -> Column:
    """Start of the day, free of time zones."""
    return F.to_date(ts).cast("timestamp_ntz")


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", day_of("ts"))
