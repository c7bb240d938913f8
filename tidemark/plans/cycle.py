"""The whole cycle as jobs over tables: calendar pages to changes, to result pages, to new results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payload as P
from tidemark.functions import urls as U
from tidemark.operators import extract as E
from tidemark.operators import summary as S
from tidemark.plans import calendar as C
from tidemark.plans import results as R
from tidemark.sources import landing as L


@dataclass(frozen=True)
class Cycle:
    """What a cycle gives, as DataFrames."""

    calendar: DataFrame
    changes: DataFrame
    targets: DataFrame
    results: DataFrame
    new_results: DataFrame
    summary: DataFrame


def calendar_raw(pages: DataFrame, root_url: str) -> DataFrame:
    """Raw rows of calendar pages ``(page_id, year, retrieved_at, html)``: a document per page."""
    key = U.landing_key("atp_results_archive", F.col("retrieved_at"), year=F.col("year"))
    return _raw(E.calendar_lists(pages, root_url), key)


def results_raw(pages: DataFrame, root_url: str) -> DataFrame:
    """Raw rows of results pages: a document per page; pages without a match give none."""
    key = U.landing_key(
        "atp_tournament", F.col("retrieved_at"),
        year=F.col("year"), tournament_id=F.col("tournament_id"),
    )
    return _raw(E.match_lists(pages, root_url), key)


def _raw(lists: DataFrame, key: Column) -> DataFrame:
    wrapped = P.envelope(F.col("data"), F.col("retrieved_at"))
    return L.raw_table(lists.select(key.alias("_key"), wrapped.alias("d")).select("_key", "d.*"), F.col("_key"))


def pages_of_targets(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Fetched results pages ``(page_id, url, retrieved_at, html)`` of the chosen tournaments."""
    wanted = targets.select(
        U.with_match_type(F.col("url")).alias("url"),
        "year", F.col("tournament").alias("tournament_name"), "tournament_id",
    )
    return pages.join(wanted, "url").drop("url")


def run_cycle(calendar_pages: DataFrame, results_pages: DataFrame, root_url: str) -> Cycle:
    """One cycle. A page or record that cannot be read is left out and stops nothing else.

    The raw calendar, its changes and the flattened matches are stored, as the steps after them
    read them several times.
    """
    raw = L.stored(calendar_raw(calendar_pages, root_url), "calendar")
    changed = L.stored(C.calendar_changes(raw, guarded=True), "changes")
    wanted = C.targets(changed, root_url)
    fetched = results_raw(pages_of_targets(wanted, results_pages), root_url)
    matches = L.stored(R.all_results(fetched), "matches")
    latest = R.latest_results(matches)
    return Cycle(
        calendar=C.calendar(raw),
        changes=changed,
        targets=wanted,
        results=latest,
        new_results=R.new_results(matches),
        summary=S.run_summary(latest, ["year", "tournament_id"]),
    )
