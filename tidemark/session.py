"""Session defaults and the shared folder that queries may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # No call sites in query errors; recording them doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # One worker batch holds this many pages, so long pages stay within worker memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. Sizes such as shuffle partitions stay with the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where the setting is missing a temporary folder is used, but only for a local master:
    on a cluster a machine's own folder is invisible to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "tidemark")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
