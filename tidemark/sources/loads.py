"""Loading a folder's new files: rows, a ledger, refused files and moves.

A load is a stream that takes what is there and ends. The file source's own log knows which files are new, so
no list of paths is made. A batch writes, in this order: its rows, its refused files, the moves it
intends, and its ledger rows, which commit it. What was written before a batch failed is replaced when it is run again.
Moves are made after that, also those of a load that ended between the two; a batch that fails leaves its files
where they are.

Refused files are kept with their text and reason. ``repair`` tries them again with a given change; what then can be
read is loaded, and what can't has one more attempt. So loaded, repaired and still refused files add up to all but those
without a single byte, which the text source passes over.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.sources import documents as D
from tidemark.sources import ledger as G
from tidemark.sources import state as St
from tidemark.sources.files import Files
from tidemark.streaming import ingest as I

RAW = "data string, meta_file_name string, meta_file_modified timestamp_ntz"
REFUSED = "meta_file_name string, data string, reason string, attempt int, repaired boolean"


def ledger(spark: SparkSession, path: str) -> St.State:
    """One row per loaded file."""
    return St.every(spark, path, ["file_uri"])


def refusals(spark: SparkSession, path: str) -> St.State:
    """The last attempt at each file that was ever refused."""
    return St.latest(spark, path, ["meta_file_name"], ["repaired"], "attempt")


def still_refused(spark: SparkSession, path: str) -> DataFrame:
    state = refusals(spark, path)
    return state.rows().filter("NOT repaired") if state.version().schema else spark.createDataFrame([], REFUSED)


def load_new(
    spark: SparkSession, path: str, target: str, ledger_path: str, endpoint: str, strict: bool = True,
    refused: str | None = None, archive: str | None = None, glob: str = "*.json", files_per_batch: int | None = None,
) -> DataFrame:
    """Files below ``path`` that were not loaded before into the folder ``target``; gives their ledger rows.

    Malformed files fail their batch if ``strict``, and are else kept in ``refused``, which must then be given.
    With ``archive`` loaded files move there. Should the log be lost, the first batch leaves out
    the files that the ledger or the target lists.
    """
    if not strict and refused is None:
        raise ValueError("say where refused files go")
    book, log = ledger(spark, ledger_path), _log(path, target)
    before = book.version().batches.get(log, -1)
    checkpoint = f"{ledger_path}/logs/{log}"

    def write(batch: DataFrame, number: int) -> None:
        if number == 0:
            batch = _without_known(batch, book, target)
        rows = D.raw_rows(batch, strict).select(*fixed.RAW_COLUMNS)
        folder = f"{target}/batch={log}-{number}"
        rows.write.mode("overwrite").parquet(folder)
        if refused is not None:
            reason = F.when(F.col("data").rlike(r"^\s*$"), "empty").otherwise("not one JSON value")
            refusals(spark, refused).add(D.quarantined(batch).select(
                "meta_file_name", "data", reason.alias("reason"), F.lit(1).alias("attempt"), F.lit(False).alias("repaired"),
            ), log, number)
        loaded = spark.read.schema(rows.schema).parquet(folder)
        if archive is not None:
            _moves(spark, loaded, path, archive).write.mode("overwrite").parquet(f"{ledger_path}/moves/{log}-{number}")
        book.add(_entries(loaded, endpoint, target), log, number)

    if archive is not None:
        _make_moves(spark, ledger_path, book, log)  # what an earlier load didn't come to
    stream = I.new_documents(spark, path, glob=glob, files_per_batch=files_per_batch)
    try:
        I.each_batch(stream, checkpoint, write).awaitTermination()
    finally:
        if archive is not None:
            _make_moves(spark, ledger_path, book, log)
    last = book.version().batches.get(log, -1)
    folders = [f"{target}/batch={log}-{n}" for n in range(before + 1, last + 1)]
    if not folders:
        return spark.createDataFrame([], G.LEDGER_SCHEMA)
    own = spark.read.schema(RAW).parquet(*folders).select(F.col("meta_file_name").alias("own"))
    return book.rows().join(own, F.col("file_uri") == F.col("own"), "left_semi")


def repair(
    spark: SparkSession, target: str, ledger_path: str, refused: str, endpoint: str, change: Callable[[Column], Column],
) -> None:
    """Try refused files again, each text after ``change``. Run again after a failure, it does only what is left."""
    state, book = refusals(spark, refused), ledger(spark, ledger_path)
    number = state.version().batches.get("repair", -1) + 1
    tried = still_refused(spark, refused).withColumn("changed", change(F.col("data")))
    rows = D.raw_rows(tried.select(F.col("changed").alias("data"), "meta_file_name"), strict=False).select(*fixed.RAW_COLUMNS)
    folder = f"{target}/batch=repair-{number}"
    rows.write.mode("overwrite").parquet(folder)
    book.add(_entries(spark.read.schema(rows.schema).parquet(folder), endpoint, target), f"repair {refused}", number)
    state.add(tried.select(
        "meta_file_name", "data", "reason", (F.col("attempt") + 1).alias("attempt"), D.well_formed(F.col("changed")).alias("repaired"),
    ), "repair", number)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The raw rows of all loads."""
    return spark.read.schema(RAW).option("recursiveFileLookup", True).parquet(target)


def _log(path: str, target: str) -> str:
    return hashlib.sha256(f"{path.rstrip('/')} {target.rstrip('/')}".encode()).hexdigest()[:16]


def _entries(rows: DataFrame, endpoint: str, target: str) -> DataFrame:
    return G.ledger_rows(rows, endpoint, target, F.lit(datetime.now(UTC).replace(tzinfo=None))).select(*G.LEDGER_COLUMNS)


def _without_known(batch: DataFrame, book: St.State, target: str) -> DataFrame:
    spark = batch.sparkSession
    if book.version().schema:
        batch = G.new_files(batch, book.rows())
    if D.exists(spark, target):
        batch = G.new_files(batch, loaded(spark, target).select(F.col("meta_file_name").alias("file_uri")))
    return batch.select("data", "meta_file_name")


def _moves(spark: SparkSession, rows: DataFrame, path: str, archive: str) -> DataFrame:
    """``(source, target)`` of each file, which keeps its place below the folder."""
    root = re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", Files(spark, path).whole(path))
    plain = F.regexp_replace("meta_file_name", r"^([A-Za-z0-9+.-]+):/+", "$1:/")
    below = F.substring(plain, F.lit(len(root) + 1), F.char_length(plain))
    return rows.select(F.col("meta_file_name").alias("source"), F.concat(F.lit(archive.rstrip("/")), below).alias("target"))


def _make_moves(spark: SparkSession, ledger_path: str, book: St.State, log: str) -> None:
    """Make the moves of committed batches. Each is a rename; one that was made before is passed over."""
    last, files = book.version().batches.get(log, -1), Files(spark, ledger_path)
    for name in files.names(f"{ledger_path}/moves"):
        own, _, number = name.rpartition("-")
        if own == log and int(number) <= last:
            moves = spark.read.schema("source string, target string").parquet(f"{ledger_path}/moves/{name}")
            for move in moves.toLocalIterator():  # names only, a partition at a time
                Files(spark, move["source"]).move(move["source"], move["target"])
            files.delete(f"{ledger_path}/moves/{name}")
