"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def rows_where(value: Column, keep: Callable[[Column], Column]) -> Column:
    """A generator that drops rows whose ``value`` fails ``keep``, and yields ``value`` else.

    A filter on a computed column is pushed below it and computes it again; this does not.
    """
    return F.explode(F.filter(F.array(value), keep))
