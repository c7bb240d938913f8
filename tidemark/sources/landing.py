"""Writing records as documents, and what is known about each document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payload as P
from tidemark.session import shared_dir

RECORDS_PER_DOCUMENT = 5000


def with_part(
    rows: DataFrame, keys: Sequence[str], record_id: Sequence[str], limit: int = RECORDS_PER_DOCUMENT,
) -> DataFrame:
    """Add ``part``, which splits each key's rows into parts of about ``limit`` rows or fewer.

    Only keys with more than ``limit`` rows are looked up, and there are at most rows / limit of
    those. ``record_id`` must tell the rows of a key apart: it decides the part, so a task that
    is run again puts each row where it was.
    """
    crowded = (
        rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > limit)
        .select(*[F.col(k).alias(f"crowded_{k}") for k in keys],
                F.ceil(F.col("n") / limit).alias("parts"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"crowded_{k}")) for k in keys]
    part = F.pmod(F.xxhash64(*record_id), F.coalesce("parts", F.lit(1))).cast("int")
    return rows.join(crowded, same, "left").select(*rows.columns, part.alias("part"))


def collect_records(
    rows: DataFrame, keys: Sequence[str], record_id: Sequence[str], fields: Sequence[str | Column],
    name: str = "records", limit: int = RECORDS_PER_DOCUMENT, partitions: int | None = None,
) -> DataFrame:
    """``(keys…, part, name)`` with a list of records, in the order of ``record_id``.

    The inverse of a flatten. A list holds about ``limit`` records at most, however many rows
    share the key. Collecting cannot shrink the rows, so they are shuffled as they are; a given
    number of ``partitions`` is kept even where they are small.
    """
    order = F.struct(*record_id).alias("o")
    record = F.struct(*fields).alias("r")
    listed = F.sort_array(F.collect_list(F.struct(order, record)))
    split = with_part(rows, keys, record_id, limit)
    by_part = [F.col(k) for k in (*keys, "part")]
    spread = split.repartition(partitions, *by_part) if partitions else split.repartition(*by_part)
    return (
        spread.groupBy(*keys, "part").agg(listed.alias("l"))
        .select(*keys, "part", F.col("l.r").alias(name))
    )


def documents(
    rows: DataFrame, keys: Sequence[str], record_id: Sequence[str], fields: Sequence[str | Column],
    retrieved_at: Column, source_url: Column | None = None, limit: int = RECORDS_PER_DOCUMENT,
) -> DataFrame:
    """Envelopes ``(keys…, part, metadata, data)`` around the records of each key."""
    listed = collect_records(rows, keys, record_id, fields, "data", limit)
    wrapped = P.envelope(F.col("data"), retrieved_at, source_url, document_name(keys), F.col("part"))
    return listed.select(*keys, "part", wrapped.alias("d")).select(*keys, "part", "d.*")


def document_name(keys: Sequence[str]) -> Column:
    """What the parts of a document have in common."""
    return F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def raw_table(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """The raw rows that loading these documents would give."""
    name = key if key is not None else F.concat_ws("/", *[
        F.col(c).cast("string") for c in docs.columns if c not in ("metadata", "data")
    ])
    return docs.select(
        P.document_text(F.struct("metadata", "data")).alias("data"),
        name.alias("meta_file_name"),
        F.to_timestamp_ntz(
            F.left("metadata.retrieved_at", F.lit(26)), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        ).alias("meta_file_modified"),
    )


def write_documents(docs: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """One pretty-printed ``.json`` file per document, below ``key=value`` folders."""
    (
        docs.select(*partitions, "metadata", "data").write
        .partitionBy(*partitions)
        .option("maxRecordsPerFile", 1)
        .option("ignoreNullFields", False)
        .option("pretty", True)
        .mode("append").json(path)
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to a new folder below the shared one and read them from there.

    For what later steps read more than once: they see columns and versions they can skip, and
    a lost executor does not start the work over.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def manifest(
    docs: DataFrame, endpoint: str, at: Column | None = None, **facts: Column,
) -> DataFrame:
    """What is stored next to each document: endpoint, count, times and the given facts.

    The parts of a document count as one; a document that doesn't name itself stands for itself.
    """
    uploaded = at if at is not None else F.to_timestamp_ntz(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    )
    uploaded_text = F.date_format(uploaded, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    counted = docs.select(
        *[value.cast("string").alias(name) for name, value in facts.items()],
        F.size("data").cast("long").alias("count"),
        F.col("metadata.retrieved_at").alias("_at"),
        *[F.col("metadata.document").alias("_document")] * ("document" in docs.schema["metadata"].dataType.names),
    )
    if "_document" in counted.columns:
        counted = counted.groupBy(*facts, "_at", "_document").agg(F.sum("count").alias("count"))
    return counted.select(
        F.lit(endpoint).alias("endpoint"),
        *facts,
        F.col("count").cast("string").alias("count"),
        F.coalesce("_at", uploaded_text).alias("scraped_at"),
        uploaded_text.alias("upload_timestamp"),
    )
