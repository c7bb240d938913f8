"""Cleaning of scraped texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed


# Everything that counts as white space in page texts, no-break and other wide blanks included.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(text: Column) -> Column:
    """Strip, and turn each inner run of white space into one blank."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def round_title(heading: Column) -> Column:
    """The part before the first `` - ``, without hyphens, each word capitalised."""
    head = F.split_part(heading, F.lit(" - "), F.lit(1))
    words = F.initcap(squeeze(F.replace(head, F.lit("-"), F.lit(""))))
    return F.coalesce(words, F.lit(fixed.UNKNOWN_ROUND))


def round_short(name: Column) -> Column:
    """Abbreviation of a round name for file names."""
    words = F.split(name, " ")
    first_letter = F.left(name, F.lit(1))
    named = F.create_map(*[F.lit(x) for pair in fixed.ROUND_CODES.items() for x in pair])
    return (
        F.when(name.contains("Round Of"), F.concat(first_letter, F.substring_index(name, " ", -1)))
        .when(name.contains("Round Qualifying"), F.concat(F.lit("Q"), first_letter))
        .when(
            name.contains("Round"),
            F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), ""),
        )
        .otherwise(F.coalesce(F.try_element_at(named, name), name))
    )


def venue_city(venue: Column) -> Column:
    place = _place(venue)
    return strip(F.split_part(place, F.lit(","), F.lit(1)))


def venue_country(venue: Column) -> Column:
    """What follows the first comma."""
    place = _place(venue)
    return F.when(
        place.contains(","), strip(F.try_element_at(F.split(place, ",", 2), F.lit(2)))
    ).otherwise(fixed.UNKNOWN_COUNTRY)


def _place(venue: Column) -> Column:
    return strip(F.rtrim(strip(F.coalesce(venue, F.lit(""))), F.lit("|")))


def seed_strip(seed: Column) -> Column:
    """A seed without the brackets around it; empty where there is none."""
    return F.coalesce(F.trim(seed, F.lit("()")), F.lit(""))


def nation_code(flag_href: Column) -> Column:
    """Code behind the ``#`` of a flag image address; a hyphen if there is none."""
    parts = F.split(F.substring_index(flag_href, "/", -1), "#")
    code = F.replace(F.try_element_at(parts, F.lit(2)), F.lit("flag-"), F.lit(""))
    return F.coalesce(code, F.lit(fixed.BAD_NATION))


def key_part(text: Column, default: str) -> Column:
    """A name as it appears in a file key: no blanks, a default where it is missing."""
    return F.replace(F.coalesce(text, F.lit(default)), F.lit(" "), F.lit("-"))


def pair_text(first: Column, second: Column) -> Column:
    """Two partners as one text."""
    return F.concat(first, F.lit(", "), second)


def singles_winner(winners: Column) -> Column:
    """Winner under the last label that names singles or a team.

    ``winners`` is array<struct<label string, names array<struct<link string, text string>>>>:
    one element per labelled list, with the names as found in the page.
    """
    labelled = F.filter(
        winners,
        lambda w: _singles_label(w["label"]) & (F.size(w["names"]) > 0),
    )
    name = F.try_element_at(F.try_element_at(labelled, F.lit(-1))["names"], F.lit(1))
    return strip(F.coalesce(name["link"], name["text"]))


def doubles_winners(winners: Column) -> Column:
    """All names under doubles labels, NULL where there is none."""
    labelled = F.filter(
        winners,
        lambda w: ~_singles_label(w["label"]) & F.lower(w["label"]).contains("doubles"),
    )
    names = F.flatten(F.transform(labelled, lambda w: w["names"]))
    kept = F.filter(names, lambda n: n["link"].isNotNull() | (strip(n["text"]) != ""))
    texts = F.transform(kept, lambda n: strip(F.coalesce(n["link"], n["text"])))
    return F.when(F.size(texts) > 0, texts)


def _singles_label(label: Column) -> Column:
    lowered = F.lower(label)
    return lowered.contains("singles") | lowered.contains("team")
