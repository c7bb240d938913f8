"""Match scores from the texts of a results page, as column expressions.

A score block is one player's row of sets; each set is the array of its texts: the games won
and, where the set had a tie-break, the points of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let


def set_scores(block: Column) -> Column:
    """``["6"]`` to ``6`` and ``["7","5"]`` to ``7(5)``; sets without a text are left out.

    A set with three or more texts repeats the score before it. It becomes NULL when there is
    none before it, which marks the whole match as unreadable.
    """
    played = F.filter(block, lambda s: F.size(s) > 0)
    return F.aggregate(
        played,
        F.array().cast("array<string>"),
        lambda done, s: F.array_append(
            done,
            F.when(F.size(s) == 1, F.get(s, F.lit(0)))
            .when(
                F.size(s) == 2,
                F.concat(F.get(s, F.lit(0)), F.lit("("), F.get(s, F.lit(1)), F.lit(")")),
            )
            .otherwise(F.try_element_at(done, F.lit(-1))),
        ),
    )


def brackets_last(score: Column) -> Column:
    """Move the first bracketed part to the end: ``7(5)6`` to ``76(5)``."""
    moved = F.regexp_replace(score, r"(?s)^([^(]*)(\([^)]*\))(.*)$", "$1$3$2")
    return F.when(score.contains("("), moved).otherwise(score)


def match_score(blocks: Column) -> Column:
    """Both players' sets side by side; empty with fewer than two blocks.

    The longer side is cut to the shorter one. NULL if a set of either side is unreadable.
    """
    sides = F.array(*[set_scores(F.get(blocks, F.lit(i))) for i in (0, 1)])
    score = let(sides, _side_by_side)
    return F.when(F.coalesce(F.size(blocks), F.lit(0)) < 2, "").otherwise(score)


def _side_by_side(sides: Column) -> Column:
    first, second = sides[0], sides[1]
    both = F.zip_with(first, second, lambda a, b: F.concat(a, b))
    shorter = F.least(F.size(first), F.size(second))
    text = F.array_join(F.transform(F.slice(both, F.lit(1), shorter), brackets_last), " ")
    unreadable = F.exists(F.flatten(sides), lambda s: s.isNull())
    return F.when(~unreadable, text)
