"""Match results: the newest row of each match, and which matches are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import versions as V
from tidemark.operators.flatten import LINEAGE, Field, flatten

# Columns of the results and the fields they are read from.
RESULT_FIELDS = (
    Field("year", "year", "int_text"),
    Field("tournament_name", "tournament_name"),
    Field("tournament_id", "tournament_id"),
    Field("round", "round"),
    Field("match_id", "match_id"),
    Field("player1_name", "player1_name"),
    Field("player1_id", "player1_id"),
    Field("player1_seed", "player1_seed"),
    Field("player1_nation", "player1_nation"),
    Field("player2_name", "player2_name"),
    Field("player2_id", "player2_id"),
    Field("player2_seed", "player2_seed"),
    Field("player2_nation", "player2_nation"),
    Field("score", "score"),
    Field("url", "url"),
)
NEW_RESULT_COLUMNS = (
    "year", "tournament_name", "tournament_id", "round", "match_id", "player1_name",
    "player1_id", "player2_name", "player2_id", "score", "url", *LINEAGE,
)
MATCH_KEY = ("year", "tournament_id", "match_id")
# Order of rows that share a match and a version. It names every other column, so the outcome
# never depends on the order in which rows arrive.
TIEBREAK = (
    "meta_file_name", "score", "url", "round", "tournament_name",
    "player1_name", "player1_id", "player1_seed", "player1_nation",
    "player2_name", "player2_id", "player2_seed", "player2_nation",
)


def all_results(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Every match of every file."""
    return flatten(raw, RESULT_FIELDS, strict=strict)


def latest_results(rows: DataFrame, tiebreak: Sequence[str] = TIEBREAK) -> DataFrame:
    """The newest row of each (year, tournament, match)."""
    return V.latest_per_key(rows, MATCH_KEY, tiebreak=tiebreak)


def new_results(
    rows: DataFrame, basis: str = "as_written", tiebreak: Sequence[str] = TIEBREAK,
) -> DataFrame:
    """Matches of each tournament's newest version that its version before does not hold.

    ``basis="as_written"`` compares the de-duplicated results and ignores the year. A match in
    both versions survives only in the newest, so within one year every match of the newest
    version counts as new, and an id used again in a later year can hide a new match.
    ``basis="intended"`` removes duplicates within a version only and compares the year too.
    """
    if basis == "as_written":
        found = _new_as_written(rows, tiebreak)
    elif basis == "intended":
        found = _new_as_intended(rows, tiebreak)
    else:
        raise ValueError(f"unknown basis {basis!r}")
    return found.select(*[c for c in NEW_RESULT_COLUMNS if c in rows.columns])


def _new_as_written(rows: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    # The versions that survive de-duplication need no sort, only the newest version per match.
    surviving = rows.groupBy(*MATCH_KEY).agg(F.max(V.VERSION).alias(V.VERSION))
    # Rows outside a tournament's latest two versions cannot matter, so they go first.
    pair = V.snapshot_pair(rows, by=["tournament_id"], versions=surviving)
    kept = latest_results(pair, tiebreak)
    # By now a match id occurs at most once per year within its tournament.
    same_match = Window.partitionBy("tournament_id", "match_id")
    in_previous = F.col("match_id").isNotNull() & (F.max("version_rank").over(same_match) == 2)
    return (
        kept.withColumn("_in_previous", in_previous)
        .filter((F.col("version_rank") == 1) & ~F.col("_in_previous"))
    )


def _new_as_intended(rows: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    pair = V.snapshot_pair(rows, by=["tournament_id"])
    # With the previous version sorted first, the top row of a match belongs to the newest
    # version only if the previous one lacks the match: no join is needed. A key with a NULL
    # equals nothing, so its versions are kept apart.
    incomplete = F.col("year").isNull() | F.col("match_id").isNull()
    apart = pair.withColumn("_apart", F.when(incomplete, F.col("version_rank")))
    top = V.latest_per_key(apart, [*MATCH_KEY, "_apart"], "version_rank", tiebreak)
    return top.filter(F.col("version_rank") == 1)
