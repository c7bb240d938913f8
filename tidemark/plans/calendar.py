"""The calendar: all versions as rows, what changed between the latest two, and what to fetch next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import urls as U
from tidemark.operators import diff as D
from tidemark.operators import versions as V
from tidemark.operators.flatten import Field, flatten
from tidemark.sources.documents import with_records

# Columns of the calendar and the fields they are read from.
CALENDAR_FIELDS = (
    Field("year", "year", "int_text"),
    Field("tournament", "tournament"),
    Field("tournament_id", "tournament_id"),
    Field("category", "category"),
    Field("city", "city"),
    Field("country", "country"),
    Field("dates", "dates"),
    Field("singles_winner", "singles_winner"),
    Field("doubles_winner", "doubles_winner", "joined"),
    Field("url", "url"),
)


def calendar(raw: DataFrame, strict: bool = True) -> DataFrame:
    """One row per tournament and file version, not de-duplicated."""
    return flatten(raw, CALENDAR_FIELDS, strict=strict)


def latest_two(
    raw: DataFrame, strict: bool = True, guarded: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Current and previous calendar. Only documents of the two versions are flattened.

    Versions are ranked over all files: a file without a tournament is no version. ``guarded``
    says that the load left such files out; then the versions alone are read, not the documents.
    """
    pair = V.snapshot_pair(raw, versions=raw if guarded else with_records(raw))
    return tuple(
        calendar(pair.filter(F.col("version_rank") == n), strict) for n in (1, 2)
    )


def newly_completed(current: DataFrame, previous: DataFrame) -> DataFrame:
    found = D.became_non_null(current, previous, "tournament_id", "url", V.VERSION)
    return D.tagged(found, fixed.NEWLY_COMPLETED, V.VERSION)


def ongoing(current: DataFrame) -> DataFrame:
    found = current.filter(F.col("url").isNotNull() & D.is_current(F.col("url")))
    return D.tagged(found, fixed.ONGOING, V.VERSION)


def changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Newly completed tournaments, and ongoing ones that are not among them.

    One join serves both: an ongoing row whose id was without an address before is newly
    completed itself. An ongoing row without an id stays only if nothing was newly completed,
    as ``NOT IN`` has it.
    """
    before = D.without_value(previous, "tournament_id", "url", V.VERSION)
    found = current.filter(F.col("url").isNotNull())
    nothing_completed = found.join(before, "tournament_id").agg(F.count("*") == 0).scalar()
    completed = F.col("_times").isNotNull()
    still_going = D.is_current(F.col("url")) & (
        F.col("tournament_id").isNotNull() | nothing_completed
    )
    change = F.when(completed, fixed.NEWLY_COMPLETED).when(still_going, fixed.ONGOING)
    changed = (
        found.join(before, "tournament_id", "left").withColumn("change_type", change)
        .filter(F.col("change_type").isNotNull())
        .withColumn("_times", F.coalesce("_times", F.lit(1)))
    )
    return D.repeat_rows(changed, "_times").select(
        *current.columns, f"previous_{V.VERSION}", "change_type"
    )


def calendar_changes(raw: DataFrame, strict: bool = True, guarded: bool = False) -> DataFrame:
    return changes(*latest_two(raw, strict, guarded))


def changes_of(rows: DataFrame) -> DataFrame:
    """Changes between the latest two versions of calendar rows, such as a state of them holds."""
    return changes(*V.current_and_previous(rows))


def targets(changed: DataFrame, root_url: str) -> DataFrame:
    """What to fetch next, with absolute addresses."""
    return changed.select(
        "year", "tournament", "tournament_id",
        U.absolute_url(F.col("url"), root_url).alias("url"),
        "change_type",
    )
