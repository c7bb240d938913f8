"""Picking up new documents once each, with Structured Streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed_values as fixed
from tidemark.sources import documents as S
from tidemark.sources.state import State, latest


def new_documents(
    spark: SparkSession, incoming: str, archive: str | None = None, glob: str = "*.json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of files that arrive below ``incoming``, one row per file.

    With ``archive`` the files of a batch move there once a later batch has committed; a batch
    that fails leaves its files where they are.
    """
    reader = (
        spark.readStream.format("text").schema("value string")
        .option("wholetext", True).option("pathGlobFilter", glob)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(incoming).select(
        F.col("value").alias("data"), S.file_name().alias("meta_file_name")
    )


def each_batch(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Process what is there now, then stop. Batch numbers repeat on a retry."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _stream_name(checkpoint: str) -> str:
    """What tells streams apart: batch numbers start again with a new checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _replace_batch(df: DataFrame, path: str, checkpoint: str, batch: int) -> str:
    """Write a batch into its own folder, so that a retry replaces it instead of adding to it."""
    folder = f"{path}/batch={_stream_name(checkpoint)}-{batch}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def _split_batch(batch: DataFrame, quarantine_path: str | None, checkpoint: str, number: int) -> DataFrame:
    """A batch's raw rows. With ``quarantine_path`` malformed files go there; without, they fail the batch."""
    if quarantine_path is not None:
        _replace_batch(S.quarantined(batch), quarantine_path, checkpoint, number)
    return S.raw_rows(batch, strict=quarantine_path is None)


def load_new(
    stream: DataFrame, table_path: str, checkpoint: str, quarantine_path: str | None = None,
) -> StreamingQuery:
    """Append each new document to the raw table at ``table_path`` exactly once.

    With ``quarantine_path`` malformed files go there and the others load; without it they fail
    the batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = _split_batch(batch, quarantine_path, checkpoint, number)
        _replace_batch(rows.select(*fixed.RAW_COLUMNS), table_path, checkpoint, number)

    return each_batch(stream, checkpoint, write)


def keep_state(
    stream: DataFrame, flatten: Callable[[DataFrame], DataFrame], state: State, checkpoint: str,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Add each batch's rows to a state, once each. A batch costs its own size and its part of merging runs."""

    def write(batch: DataFrame, number: int) -> None:
        state.add(flatten(_split_batch(batch, quarantine_path, checkpoint, number)), _stream_name(checkpoint), number)

    return each_batch(stream, checkpoint, write)


def keep_latest(
    stream: DataFrame, flatten: Callable[[DataFrame], DataFrame], keys: Sequence[str],
    state_path: str, checkpoint: str, tiebreak: Sequence[str] = (), quarantine_path: str | None = None, **options: int,
) -> StreamingQuery:
    """Maintain the newest row per key. Versions decide, not the order of arrival."""
    state = latest(stream.sparkSession, state_path, keys, tiebreak, **options)
    return keep_state(stream, flatten, state, checkpoint, quarantine_path)


def latest_state(
    spark: SparkSession, state_path: str, keys: Sequence[str], tiebreak: Sequence[str] = (),
) -> DataFrame:
    return latest(spark, state_path, keys, tiebreak).rows()


def after_each_batch(
    stream: DataFrame, flatten: Callable[[DataFrame], DataFrame], state: State, table_path: str, checkpoint: str,
    refresh: Callable[[DataFrame, int], None], quarantine_path: str | None = None,
) -> StreamingQuery:
    """Load each batch, add its rows to a state, then hand the state to ``refresh``, such as a snapshot diff.

    The raw table only grows by the batch; what is read again is the batch and the state.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        rows = _split_batch(batch, quarantine_path, checkpoint, number).select(*fixed.RAW_COLUMNS)
        folder = _replace_batch(rows, table_path, checkpoint, number)
        state.add(flatten(spark.read.schema(rows.schema).parquet(folder)), _stream_name(checkpoint), number)
        refresh(state.rows(), number)

    return each_batch(stream, checkpoint, write)
