"""Versions of a snapshot: the newest, the newest per key, their ranks, the latest two.

A version is identified by its timestamp. All files with one timestamp belong to one version.
Rows without a timestamp belong to none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "meta_file_modified"


def latest_row(df: DataFrame, version: str = VERSION, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The one newest row. Sorted top-1 per partition, then over those; no window."""
    return df.orderBy(F.col(version).desc_nulls_last(), *_desc(tiebreak)).limit(1)


def latest_version(df: DataFrame, version: str = VERSION) -> DataFrame:
    """All rows of the newest version. The bound is a scalar subquery, so the scan can use it."""
    return df.filter(F.col(version) == df.agg(F.max(version)).scalar())


def latest_group(df: DataFrame, group: Column, version: str = VERSION) -> DataFrame:
    """All rows of the newest version that share its largest ``group``, such as a document in parts."""
    named = latest_version(df, version).withColumn("_group", group)
    return named.filter(F.col("_group") == named.agg(F.max("_group")).scalar()).drop("_group")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str = VERSION, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The newest row of each key. NULLs form a key; versions that are NULL come last.

    Every map task keeps one row per key before the shuffle, so a key with very many rows
    does not reach one task whole.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(), *_desc(tiebreak))
    ranked = df.withColumn("_rn", F.row_number().over(newest))
    return ranked.filter("_rn = 1").drop("_rn")


def _desc(names: Sequence[str]) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def top_versions(df: DataFrame, k: int, version: str = VERSION) -> DataFrame:
    """The k newest distinct versions."""
    return (
        df.select(version).filter(F.col(version).isNotNull()).distinct()
        .orderBy(F.desc(version)).limit(k)
    )


def version_rank(df: DataFrame, by: Sequence[str] = (), version: str = VERSION, ranges: int | None = None) -> DataFrame:
    """``(by…, version, version_rank)``: dense rank of each distinct version, newest first.

    Versions are dealt into ranges of about equal size, whatever days they fall on, and ranked within their range; then
    they are moved up by the number of versions in later ranges. Only counts of ranges are ordered as a whole.
    The borders are estimates, which the ranks don't depend on. NULL comes last. ``ranges`` is the number of
    shuffle partitions by default.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = df.select(*by, version).distinct()
    number = _as_number(F.col(version), df.schema[version].dataType)
    borders = df.agg(F.percentile_approx(number, [k / ranges for k in range(1, ranges)] or [0.5])).scalar()
    # How many borders lie above: 0 is the newest range.
    above = F.size(F.filter("_borders", lambda b: b > number))
    dealt = F.when(F.col(version).isNull() | F.col("_borders").isNull(), ranges).otherwise(above)
    dated = distinct.withColumn("_borders", borders).withColumn("_range", dealt).drop("_borders")
    counts = dated.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    later = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_same_{c}") for c in (*by, "_range")],
        F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_later"),
    )
    in_range = F.dense_rank().over(
        Window.partitionBy(*by, "_range").orderBy(F.col(version).desc_nulls_last())
    )
    same = [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in (*by, "_range")]
    rank = (F.col("_later") + F.col("_in_range")).cast("int").alias("version_rank")
    return dated.withColumn("_in_range", in_range).join(offsets, same).select(*by, version, rank)


def _as_number(version: Column, kind: T.DataType) -> Column:
    """A number in the order of the versions."""
    if isinstance(kind, T.NumericType):
        return version
    if isinstance(kind, T.DateType):
        return F.unix_date(version)
    return F.unix_micros(version.cast("timestamp"))


def _latest_versions(df: DataFrame, by: Sequence[str], k: int, version: str) -> DataFrame:
    """The k newest versions of each key with their rank; each map task keeps k per key."""
    newest = Window.partitionBy(*by).orderBy(F.col(version).desc_nulls_last())
    ranked = df.select(*by, version).distinct().withColumn("version_rank", F.dense_rank().over(newest))
    return ranked.filter(F.col("version_rank") <= k)


def snapshot_pair(
    df: DataFrame, by: Sequence[str] = (), version: str = VERSION, versions: DataFrame | None = None,
) -> DataFrame:
    """Rows of the newest and second-newest version, overall or per key, with ``version_rank``.

    ``versions`` may give the versions to rank where they are known more cheaply than by ``df``.
    """
    source = df if versions is None else versions
    if by:
        return df.join(_latest_versions(source, by, 2, version), [*by, version])
    # Two scalar subqueries bound the scan; rows of older versions are never parsed further.
    latest = top_versions(source, 2, version)
    newest = latest.agg(F.max(version)).scalar()
    oldest = latest.agg(F.min(version)).scalar()
    rank = F.when(F.col(version) == newest, 1).otherwise(2)
    return df.filter(F.col(version) >= oldest).withColumn("version_rank", rank)


def current_and_previous(
    df: DataFrame, by: Sequence[str] = (), version: str = VERSION, versions: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of the newest version and rows of the one before it."""
    pair = snapshot_pair(df, by, version, versions)
    return tuple(pair.filter(F.col("version_rank") == n).drop("version_rank") for n in (1, 2))
