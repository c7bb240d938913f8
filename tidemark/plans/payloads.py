"""Match payloads: addresses to ask, and responses to keyed documents, their manifest, and what is set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import payload as P
from tidemark.functions import urls as U
from tidemark.functions.binding import let

ENDPOINT = "match_stats"
PLAIN, *ENCRYPTED = fixed.MATCH_DATA_URLS


def addresses(matches: DataFrame, root_url: str, base_url: str, kinds: Sequence[str] = tuple(fixed.MATCH_DATA_URLS)) -> DataFrame:
    """Matches ``(…, year, tournament_id, match_id)``, once for each kind of data, with ``data_type`` and ``url``."""
    each = matches.withColumn("data_type", F.explode(F.array(*[F.lit(k) for k in kinds])))
    return each.withColumn("url", U.match_data_url(
        F.col("data_type"), F.col("year"), F.col("tournament_id"), F.col("match_id"), root_url, base_url
    ))


def opened(payloads: DataFrame) -> DataFrame:
    """Payloads ``(…, data_type, lastModified, response)`` with ``data``, their JSON text.

    One kind is plain, the others are encrypted. ``data`` is NULL where a kind is unknown, a payload can't be
    decrypted, or what comes out is no JSON.
    """
    kind = F.col("data_type")
    text = F.when(kind == PLAIN, F.col("response")).when(
        kind.isin(*ENCRYPTED), P.decrypted_text(F.col("lastModified"), F.col("response"))
    )
    json = let(text, lambda t: F.when(F.try_parse_json(t).isNotNull(), t))
    return payloads.withColumn("data", json)


def readable(found: DataFrame) -> DataFrame:
    return found.filter(F.col("data").isNotNull())


def set_aside(found: DataFrame) -> DataFrame:
    return found.filter(F.col("data").isNull()).drop("data")


def landing_key() -> Column:
    """Where a payload of ``(round, player1_name, player2_name, match_id, data_type, retrieved_at, …)`` lands."""
    name = U.match_file_name(
        F.col("round"), F.col("player1_name"), F.col("player2_name"), F.col("match_id"), F.col("data_type"), F.col("retrieved_at")
    )
    return U.landing_key(
        ENDPOINT, F.col("retrieved_at"), year=F.col("year"), tournament_id=F.col("tournament_id"), filename=name
    )


def documents(found: DataFrame) -> DataFrame:
    """Raw rows ``(data, meta_file_name, meta_file_modified)`` of opened payloads: a document each, under its key."""
    wrapped = P.envelope(F.parse_json("data"), F.col("retrieved_at"))
    return readable(found).select(
        P.document_text(wrapped).alias("data"),
        landing_key().alias("meta_file_name"),
        F.col("retrieved_at").cast("timestamp_ntz").alias("meta_file_modified"),
    )


def manifest(found: DataFrame) -> DataFrame:
    """What is stored next to each document, with its key."""
    text = lambda c: F.col(c).cast("string").alias(c)
    return readable(found).select(
        landing_key().alias("key"), F.lit(ENDPOINT).alias("endpoint"), "data_type", text("year"), text("tournament_id"),
        F.upper("match_id").alias("match_id"),
        F.date_format("retrieved_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("scraped_at"),
    )
