"""Landed documents: from files to the raw table, one row per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import json_values as J
from tidemark.functions.binding import let
from tidemark.sources.files import Files


def scan_documents(
    spark: SparkSession, path: str | list[str], glob: str = "*.json", partitions: Sequence[str] = (),
) -> DataFrame:
    """One row per matching file below ``path``: its whole text and its name.

    Sub-folders are read only where they are Hive-style (``year=2024``); filters on the columns
    they give, named in ``partitions`` to keep them, skip files without reading them.
    """
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return files.select(F.col("value").alias("data"), file_name().alias("meta_file_name"), *partitions)


def file_name() -> Column:
    """Name of the file a row was read from, without URI escapes."""
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(escaped)


def retrieved_at(data: Column, strict: bool = True) -> Column:
    return J.utc_timestamp(F.get_json_object(data, "$.metadata.retrieved_at"), strict)


def well_formed(data: Column) -> Column:
    """Whether a text is one JSON value and nothing else.

    The parser stops behind the first value. As the first element of a list that ends in a zero,
    the text is followed by exactly that only if nothing else follows it.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), data, F.lit(",0]")))
    only = let(listed, lambda v: (F.try_variant_get(v, "$[1]", "int") == 0)
               & F.try_variant_get(v, "$[2]", "variant").isNull())
    return F.coalesce(only, F.lit(False))


def raw_rows(scanned: DataFrame, strict: bool = True) -> DataFrame:
    """``(data, meta_file_name, meta_file_modified)``. Malformed text fails, or is dropped if not strict."""
    extra = [c for c in scanned.columns if c not in fixed.RAW_COLUMNS]
    if strict:
        message = F.concat(F.lit("malformed JSON in "), F.coalesce("meta_file_name", F.lit("?")))
        data = F.when(well_formed(F.col("data")), F.col("data")).otherwise(
            F.raise_error(message).cast("string")
        )
    else:
        data = F.col("data")
        scanned = scanned.filter(well_formed(data))
    return scanned.select(
        data.alias("data"),
        "meta_file_name",
        retrieved_at(F.col("data"), strict).alias("meta_file_modified"),
        *extra,
    )


def quarantined(scanned: DataFrame) -> DataFrame:
    """Files whose text is not JSON."""
    return scanned.filter(~well_formed(F.col("data")))


def record_count(path: str = "data") -> Column:
    """Number of records of a document; 0 where there is no list of them."""
    return F.coalesce(F.json_array_length(F.get_json_object("data", f"$.{path}")), F.lit(0))


def document_id() -> Column:
    """What tells documents apart: the name that the parts of one share, or the file's."""
    return F.coalesce(F.get_json_object("data", "$.metadata.document"), F.col("meta_file_name"))


def with_records(raw: DataFrame, path: str = "data") -> DataFrame:
    """Documents that hold at least one record; the others are not worth loading."""
    return raw.filter(record_count(path) > 0)


def append_raw(raw: DataFrame, target: str) -> None:
    """Append to a table, by position, or to a folder. Either is created on first use."""
    rows = raw.select(*fixed.RAW_COLUMNS)
    if "/" in target:
        rows.write.mode("append").parquet(target)
    elif rows.sparkSession.catalog.tableExists(target):
        rows.write.insertInto(target)
    else:
        rows.write.format("parquet").saveAsTable(target)


def raw_source(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def load_raw(
    spark: SparkSession, path: str, target: str, strict: bool = True, require_records: bool = False,
) -> int:
    """Files below ``path`` into a table or folder; returns its row count afterwards.

    With ``require_records`` a load without a single record fails.
    """
    raw = raw_rows(scan_documents(spark, path), strict)
    if require_records and with_records(raw).isEmpty():
        raise ValueError(f"no records below {path}")
    append_raw(raw, target)
    return raw_source(spark, target).count()


def exists(spark: SparkSession, target: str) -> bool:
    """Whether a table or folder is there."""
    if "/" not in target:
        return spark.catalog.tableExists(target)
    return Files(spark, target).exists(target)


def inferred_schema(raw: DataFrame, sample: Column | None = None) -> DataFrame:
    """One row: the merged JSON schema of all documents."""
    value = F.try_parse_json(sample if sample is not None else F.col("data"))
    return raw.agg(F.schema_of_variant_agg(value).alias("json_schema"))
