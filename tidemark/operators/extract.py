"""Records from tables of pages, payloads and strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import html as H
from tidemark.functions import payload as P
from tidemark.functions import scores as S
from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.functions.binding import let, rows_where


def _explode_records(pages: DataFrame, found: Column) -> DataFrame:
    carried = [c for c in pages.columns if c != "html"]
    return pages.select(*carried, F.posexplode(found).alias("position", "r"))


def _page_lists(
    pages: DataFrame, found: Column, keep: Callable[[Column], Column], record: Callable[[Column], Column],
) -> DataFrame:
    """One row per page with ``data``, the list of its records; pages without any are left out.

    A page's records stay together, so nothing is shuffled, and the page is read once.
    """
    carried = [c for c in pages.columns if c != "html"]
    records = F.transform(F.filter(found, keep), record)
    return pages.select(*carried, rows_where(records, lambda r: F.size(r) > 0).alias("data"))


# Calendar pages ---------------------------------------------------------------------------


def _calendar_found() -> Column:
    return H.records(F.col("html"), H.calendar_events, H.CALENDAR_BLOCKS, H.CALENDAR_DDL, H.CALENDAR_RECORD)


def _readable_event(r: Column) -> Column:
    return r["error"].isNull()


def _calendar_record(r: Column, root_url: str) -> Column:
    return F.struct(
        F.col("year").alias("year"),
        T.strip(r["name"]).alias("tournament"),
        U.profile_id(r["profile_href"]).alias("tournament_id"),
        F.coalesce(T.strip(r["badge"]), F.lit(fixed.OTHER_CATEGORY)).alias("category"),
        T.venue_city(r["venue"]).alias("city"),
        T.venue_country(r["venue"]).alias("country"),
        F.coalesce(T.strip(r["dates"]), F.lit("")).alias("dates"),
        T.singles_winner(r["winners"]).alias("singles_winner"),
        T.doubles_winners(r["winners"]).alias("doubles_winner"),
        F.concat(F.lit(root_url), r["results_href"]).alias("url"),
    )


def calendar_candidates(pages: DataFrame) -> DataFrame:
    """All event blocks of calendar pages, readable or not; column ``html`` is consumed."""
    return _explode_records(pages, _calendar_found())


def calendar_records(pages: DataFrame, root_url: str) -> DataFrame:
    """Tournaments of calendar pages ``(…, year, html)``. Unreadable blocks are left out."""
    r = F.col("r")
    carried = [c for c in pages.columns if c not in ("html", "year")]
    events = calendar_candidates(pages).filter(_readable_event(r))
    return events.select(*carried, "position", _calendar_record(r, root_url).alias("c")).select(
        *carried, "position", "c.*"
    )


def calendar_lists(pages: DataFrame, root_url: str) -> DataFrame:
    """The same tournaments as one list ``data`` per page."""
    return _page_lists(
        pages, _calendar_found(), _readable_event, lambda r: _calendar_record(r, root_url)
    )


# Results pages ----------------------------------------------------------------------------


def _matches_found() -> Column:
    return H.records(F.col("html"), H.matches, H.RESULTS_BLOCKS, H.MATCH_DDL, H.MATCH_RECORD)


def match_candidates(pages: DataFrame) -> DataFrame:
    """All match blocks of results pages, readable or not; column ``html`` is consumed."""
    return _explode_records(pages, _matches_found())


def readable_match(r: Column) -> Column:
    """Whether a match block yields a record.

    Players' addresses must hold an id. Partners in doubles all need a name and an address, and
    all or none of them a seed where the first or third has one.
    """
    players, count = r["players"], F.size(r["players"])
    at = lambda i: F.get(players, F.lit(i))
    has_id = lambda p: ~p["broken"] & U.player_id(p["href"]).isNotNull()
    lead_seed = at(0)["seed"].isNotNull() | at(2)["seed"].isNotNull()
    singles = F.forall(players, lambda p: ~p["broken"] & (p["href"].isNull() | has_id(p)))
    doubles = F.forall(players, lambda p: p["name"].isNotNull() & F.coalesce(has_id(p), F.lit(False)))
    seeds = ~lead_seed | F.forall(players, lambda p: p["seed"].isNotNull())
    return (
        r["error"].isNull()
        & F.when(count == 2, singles).when(count == 4, doubles & seeds).otherwise(F.lit(True))
        & S.match_score(r["scores"]).isNotNull()
    )


def _side(r: Column, first: int, field: Callable[[Column], Column]) -> Column:
    """One side of a match: a player, or two partners."""
    n = F.size(r["players"])
    player = lambda i: field(F.get(r["players"], F.lit(i)))
    return (
        F.when(n == 2, player(first))
        .when(n == 4, T.pair_text(player(2 * first), player(2 * first + 1)))
        .otherwise("")
    )


def _seed(r: Column, first: int) -> Column:
    n = F.size(r["players"])
    seed = lambda i: T.seed_strip(F.get(r["players"], F.lit(i))["seed"])
    return F.when(n == 2, seed(first)).when(n == 4, seed(2 * first)).otherwise("")


def _nation(r: Column, first: int) -> Column:
    flags, players = r["flags"], F.size(r["players"])
    malformed = lambda f: ~F.substring_index(f, "/", -1).contains("#")
    code = lambda i: T.nation_code(F.get(flags, F.lit(i)))
    singles = (
        F.when(F.size(flags) < 2, "")
        .when(F.exists(F.slice(flags, 1, 2), lambda f: f.isNotNull() & malformed(f)), fixed.BAD_NATION)
        .otherwise(code(first))
    )
    doubles = (
        F.when(F.size(flags) < 4, "")
        .when(F.exists(F.slice(flags, 1, 4), lambda f: f.isNull() | malformed(f)), fixed.BAD_NATION)
        .otherwise(T.pair_text(code(2 * first), code(2 * first + 1)))
    )
    return F.when(players == 2, singles).when(players == 4, doubles).otherwise("")


def _match_record(r: Column, root_url: str) -> Column:
    url = F.coalesce(F.concat(F.lit(root_url), r["stats_href"]), F.lit(""))
    name = lambda p: F.coalesce(p["name"], F.lit(""))
    ident = lambda p: F.coalesce(U.player_id(p["href"]), F.lit(""))
    return F.struct(
        T.round_title(r["heading"]).alias("round"),
        _side(r, 0, name).alias("player1_name"),
        _side(r, 0, ident).alias("player1_id"),
        _seed(r, 0).alias("player1_seed"),
        _nation(r, 0).alias("player1_nation"),
        _side(r, 1, name).alias("player2_name"),
        _side(r, 1, ident).alias("player2_id"),
        _seed(r, 1).alias("player2_seed"),
        _nation(r, 1).alias("player2_nation"),
        S.match_score(r["scores"]).alias("score"),
        url.alias("url"),
        U.last_segment(url).alias("match_id"),
        F.col("year").alias("year"),
        F.col("tournament_name").alias("tournament_name"),
        F.col("tournament_id").alias("tournament_id"),
    )


def match_records(pages: DataFrame, root_url: str) -> DataFrame:
    """Matches of results pages ``(…, year, tournament_name, tournament_id, html)``."""
    r = F.col("r")
    own = ("html", "year", "tournament_name", "tournament_id")
    carried = [c for c in pages.columns if c not in own]
    readable = match_candidates(pages).filter(readable_match(r))
    return readable.select(*carried, "position", _match_record(r, root_url).alias("m")).select(
        *carried, "position", "m.*"
    )


def match_lists(pages: DataFrame, root_url: str) -> DataFrame:
    """The same matches as one list ``data`` per page."""
    return _page_lists(pages, _matches_found(), readable_match, lambda r: _match_record(r, root_url))


# Any page, payloads -----------------------------------------------------------------------


def page_links(pages: DataFrame) -> DataFrame:
    """Title, first heading and each navigation link of any page."""
    found = H.records(F.col("html"), H.navigation_links, H.LINK_BLOCKS, H.LINK_DDL, H.LINK_RECORD)
    return _explode_records(pages, found).filter("r.error IS NULL").select("*", "r.*").drop("r", "error")


# What is set aside ------------------------------------------------------------------------


def unreadable_events(pages: DataFrame) -> DataFrame:
    """Blocks of calendar pages that give no tournament, and pages that can't be read, with their ``error``."""
    return _set_aside(calendar_candidates(pages), _readable_event)


def unreadable_matches(pages: DataFrame) -> DataFrame:
    """Blocks of results pages that give no match, and pages that can't be read, with their ``error``."""
    return _set_aside(match_candidates(pages), readable_match)


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Pages that the parser gives up on, with its ``error``."""
    found = H.records(F.col("html"), H.navigation_links, H.LINK_BLOCKS, H.LINK_DDL, H.LINK_RECORD)
    return _set_aside(_explode_records(pages, found), lambda r: ~F.coalesce(r["error"].startswith(H.PAGE_ERROR), F.lit(False)))


def _set_aside(candidates: DataFrame, readable: Callable[[Column], Column]) -> DataFrame:
    r = F.col("r")
    error = F.coalesce(r["error"], F.lit("no complete record")).alias("error")
    return candidates.filter(~F.coalesce(readable(r), F.lit(False))).select(
        *[c for c in candidates.columns if c != "r"], error
    )


def _payload_text() -> Column:
    """Decrypted JSON text of a payload, NULL if it cannot be decrypted or is no JSON."""
    plain = P.decrypted_text(F.col("lastModified"), F.col("response"))
    return let(plain, lambda text: F.when(F.try_parse_json(text).isNotNull(), text))


def readable_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads ``(…, lastModified, response)`` with ``data``, their decrypted JSON text."""
    return payloads.withColumn("data", rows_where(_payload_text(), lambda d: d.isNotNull()))


def unreadable_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads to set aside."""
    return payloads.filter(_payload_text().isNull())
