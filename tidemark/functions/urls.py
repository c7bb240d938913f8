"""Addresses and landing keys, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import text as T


def path_segment(url: Column, n: int) -> Column:
    """The n-th ``/``-separated part behind the scheme; empty if there are fewer."""
    return F.split_part(F.regexp_replace(url, "^https?://", ""), F.lit("/"), F.lit(n))


def last_segment(url: Column) -> Column:
    """What follows the last ``/``, empty for a missing address."""
    return F.coalesce(F.substring_index(url, "/", -1), F.lit(""))


def profile_id(href: Column) -> Column:
    """Second-to-last path part; NULL unless the path has more than two parts."""
    parts = F.split(F.trim(href, F.lit("/")), "/")
    return F.when(F.size(parts) > 2, F.try_element_at(parts, F.lit(-2)))


def player_id(href: Column) -> Column:
    """Second-to-last part of the address as written; NULL if it has no ``/``."""
    return F.try_element_at(F.split(href, "/"), F.lit(-2))


def absolute_url(url: Column, root: str) -> Column:
    return F.when((url != "") & ~url.startswith("http"), F.concat(F.lit(root), url)).otherwise(url)


def with_match_type(url: Column, match_type: str = "singles") -> Column:
    """Ask for one match type unless the address already does."""
    return F.when(url.contains("matchType"), url).otherwise(
        F.concat(url, F.lit(f"?matchType={match_type}"))
    )


def fill(template: str, **values: Column) -> Column:
    """Put columns into a template with ``{name}`` places; an unknown name is an error."""
    pieces = []
    for literal, name in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if literal:
            pieces.append(F.lit(literal))
        if name:
            if name not in values:
                raise KeyError(f"template needs a value for {name!r}")
            pieces.append(values[name].cast("string"))
    return F.concat(*pieces)


def timestamp_text(at: Column) -> Column:
    return F.date_format(at, fixed.TIMESTAMP_FORMAT)


def landing_key(endpoint: str, at: Column, /, **values: Column) -> Column:
    """Where a document of this endpoint lands. Endpoints without a path of their own share one."""
    template = fixed.LANDING_PATHS.get(endpoint, fixed.GENERIC_LANDING_PATH)
    return fill(template, **{
        "endpoint": F.lit(endpoint),
        "year": F.date_format(at, "yyyy"),
        "month": F.date_format(at, "MM"),
        "timestamp": timestamp_text(at),
        **values,
    })


def match_file_name(
    round_name: Column, player1: Column, player2: Column,
    match_id: Column, data_type: Column, at: Column,
) -> Column:
    return fill(
        fixed.MATCH_FILE_NAME,
        round=T.round_short(F.coalesce(round_name, F.lit("R"))),
        player1=T.key_part(player1, "P1"),
        player2=T.key_part(player2, "P2"),
        match_id=F.upper(match_id),
        data_type=data_type,
        timestamp=timestamp_text(at),
    )


def match_data_url(
    data_type: Column, year: Column, tourn_id: Column, match_id: Column,
    root_url: str, base_url: str, strict: bool = True,
) -> Column:
    """Address of one kind of match data; an unknown kind fails, or gives NULL if not strict."""
    known = dict(
        root_url=F.lit(root_url), base_url=F.lit(base_url),
        year=year, tourn_id=tourn_id, match_id=F.upper(match_id),
    )
    result = F.lit(None).cast("string")
    if strict:
        result = F.raise_error(F.concat(F.lit("unknown data type: "), data_type)).cast("string")
    for name, template in fixed.MATCH_DATA_URLS.items():
        result = F.when(data_type == name, fill(template, **known)).otherwise(result)
    return result
