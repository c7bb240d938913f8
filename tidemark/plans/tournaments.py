"""Tournament details: the newest file, flattened over two levels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import versions as V
from tidemark.operators.flatten import Field, flatten
from tidemark.sources.documents import document_id

LEVELS = ("data.TournamentDates", "Tournaments")

# Columns of the details and the fields they are read from.
TOURNAMENT_FIELDS = (
    Field("tournament_id", "Id"),
    Field("tournament_name", "Name"),
    Field("location", "Location"),
    Field("formatted_date", "FormattedDate"),
    Field("surface", "Surface"),
    Field("indoor_outdoor", "IndoorOutdoor"),
    Field("total_financial_commitment", "TotalFinancialCommitment"),
    Field("prize_money_details", "PrizeMoneyDetails"),
    Field("singles_draw_size", "SglDrawSize", "int"),
    Field("doubles_draw_size", "DblDrawSize", "int"),
    Field("event_type", "Type"),
    Field("challenger_category", "ChallengerCategory"),
    Field("tournament_overview_url", "TournamentOverviewUrl"),
    Field("tournament_site_url", "TournamentSiteUrl"),
    Field("scores_url", "ScoresUrl"),
    Field("is_live", "IsLive", "boolean"),
    Field("is_past_event", "IsPastEvent", "boolean"),
)


def tournaments(raw: DataFrame, strict: bool = True, whole_version: bool = False) -> DataFrame:
    """Details from the newest document with all its parts, or from all files of the newest version."""
    newest = V.latest_version(raw) if whole_version else V.latest_group(raw, document_id())
    return flatten(newest, TOURNAMENT_FIELDS, LEVELS, strict)
