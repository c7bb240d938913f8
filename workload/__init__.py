"""The library's operators bound to the given tables, each with the SQL it must agree with.

The Spark side takes the way real data takes: records become documents, documents become raw
rows, raw rows are flattened. The SQL side reads the tables directly, so a mistake in the JSON
cannot cancel out.
"""

from workload import calendar, extraction, json_values, landing, quality, results, streams, versions, web
from workload.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "calendar", "extraction", "json_values", "landing", "quality",
    "results", "streams", "versions", "web",
]
