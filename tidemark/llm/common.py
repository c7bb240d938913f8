"""What the operators share: reading tables, bounded batches, checkpoints, words, split tests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Rows in one Arrow batch at most, so that a batch of long texts fits in a Python worker.
BATCH_ROWS = 512

#: A word, wherever texts are cut into words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's rows per Arrow batch to ``rows``, if they are more."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to ``spark.checkpoint.dir``, from where lost parts are read again."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, parts: int) -> Column:
    """``crc32`` of the id as text modulo ``parts``. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lowered. Splitting at white space leaves empty strings only at the ends."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum up to ``limit`` at most; a larger item stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin in arrays that are sorted together."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)
