"""Documents at their keys, with a manifest that lists what is there.

A batch is written beside first, a file per key, then each file is renamed to its key, and last the manifest takes
the batch's rows in one switch. A file that the manifest lists is always there and whole. A batch that
ends half-way is written again as a whole; one that the manifest knows isn't written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import landing as L
from tidemark.sources import state as St
from tidemark.sources.files import Files


def listed(spark: SparkSession, path: str) -> St.State:
    """The manifest: a row per key."""
    return St.every(spark, path, ["key"])


def write_documents(
    docs: DataFrame, key: Column, root: str, manifest: str, endpoint: str, writer: str, batch: int, **facts: Column,
) -> bool:
    """``(metadata, data)`` of each row as pretty JSON at ``root/key``. False if the batch was written before.

    Keys must be distinct: parts of a document need keys of their own.
    """
    spark = docs.sparkSession
    book = listed(spark, manifest)
    if book.version().batches.get(writer, -1) >= batch:
        return False
    rows = docs.withColumn("key", key)
    staged = f"{manifest}/staged/{writer}-{batch}"
    text = F.to_json(F.struct("metadata", "data"), {"pretty": "true", "ignoreNullFields": "false"})
    rows.select(F.col("key").alias("_key"), text.alias("value")).write.mode("overwrite").partitionBy("_key").text(staged)
    written = spark.read.text(staged, wholetext=True)
    if "_key" in written.columns:
        repeated = rows.groupBy("key").count().filter("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"{repeated.first()['key']!r} is the key of several documents")
        entries = L.manifest(rows, endpoint, key=F.col("key"), **facts)
        places = written.select("_key", F.col("_metadata.file_path").alias("path"))
        for place in places.toLocalIterator():  # names only, a partition at a time
            source = place["path"].replace("+", "%2B")
            Files(spark, root).move(_as_named(spark, source), f"{root.rstrip('/')}/{place['_key']}", replace=True)
        book.add(entries, writer, batch)
    Files(spark, manifest).delete(staged)
    return True


def _as_named(spark: SparkSession, uri: str) -> str:
    """The path of a file as the file system names it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
