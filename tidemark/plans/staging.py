"""The five relations over the three raw tables, as views, and the checks on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidemark.operators import quality as Q
from tidemark.plans import calendar as C
from tidemark.plans import results as R
from tidemark.plans.tournaments import tournaments
from tidemark.sources.landing import stored
from tidemark.sources.sql_text import register_views

# What must not be NULL in each relation, and what must be unique.
NOT_NULL = {
    "calendar": ("tournament_id", "meta_file_modified"),
    "calendar_changes": ("tournament_id", "url"),
    "tournaments": ("tournament_id",),
    "results": ("match_id", "tournament_id", "year"),
    "new_results": ("match_id", "tournament_id"),
}
UNIQUE = {
    "calendar": ("tournament_id", "meta_file_modified"),
    "calendar_changes": ("tournament_id",),
    "tournaments": ("tournament_id",),
    "results": ("year", "tournament_id", "match_id"),
}


def staging(
    calendar_raw: DataFrame, tournaments_raw: DataFrame, results_raw: DataFrame,
    basis: str = "as_written", guarded: bool = False, whole_version: bool = False, store: bool = False,
) -> dict[str, DataFrame]:
    """All relations by name, nothing computed yet.

    With ``store`` the flattened calendar and matches are written once and read from there, so that
    no document is parsed again for each relation and check over them.
    """
    matches, calendar = R.all_results(results_raw), C.calendar(calendar_raw)
    if store:
        matches, calendar = stored(matches, "matches"), stored(calendar, "calendar")
    return {
        "calendar": calendar,
        "calendar_changes": C.calendar_changes(calendar_raw, guarded=guarded),
        "tournaments": tournaments(tournaments_raw, whole_version=whole_version),
        "results": R.latest_results(matches),
        "new_results": R.new_results(matches, basis),
    }


def register(relations: dict[str, DataFrame]) -> None:
    register_views(**relations)


def checks(relations: dict[str, DataFrame]) -> DataFrame:
    """``(check, failures)``; one pass over each relation."""
    return reduce(DataFrame.unionByName, [
        Q.suite(name, df, NOT_NULL.get(name, ()), UNIQUE.get(name, ()))
        for name, df in relations.items()
    ])
