"""Reports over typed documents ``(metadata struct, tournaments array<struct>)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten_structs
from tidemark.operators.summary import count_by


def tournaments_of_year(docs: DataFrame, year: int) -> DataFrame:
    """Tournaments of the documents of one year. The filter runs before the unnest."""
    return flatten_structs(docs.filter(F.col("metadata.year") == year), "tournaments").select(
        "tournament", "city", "country", "category", "singles_winner"
    )


def tournaments_by_category(docs: DataFrame) -> DataFrame:
    return count_by(flatten_structs(docs, "tournaments"), "category", "tournament_count")
