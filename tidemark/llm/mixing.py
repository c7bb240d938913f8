"""Mixing sources to target weights by entropy balancing.

Rates of documents are sought that take ``target`` words of each source and else differ as little as can
be from the documents' base rates, by relative entropy over words. The convex dual has one multiplier
for each source, and a document's rate is its base rate, exponentially tilted by its source's
multiplier, up to ``MOST``. Newton's iterations run over the corpus: each sums words and their
derivative by source in Spark, and takes a step for all multipliers; steps out of the known bracket are
halved. Rates are then rounded into copies: a document gets its rate's whole part, and one more if its
hash is below the rest. A common shift of that limit, found from two histograms of the whole source,
brings the source's words as near to the target as its documents allow.

Hashes hang on the id, source and size only, so reruns agree however rows are dealt out.

Defined results: a null or empty text has size 0 and counts in its source, as does a null id. A null
source is a source of its own, behind all others. Sources without words have target 0. Repeated rows
count each. If there are no rows, there are no sources.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored

#: A document is taken so many times at most, and so is a source.
MOST = 3.0
#: Sources at most, as their targets and multipliers pass through the driver.
MAX_SOURCES = 100_000
#: Bins of each of the two histograms that the rounding takes its limit from.
BINS = 4096
#: Newton's iterations end when the words of each source are within this share of the target.
TOLERANCE, STEPS = 1e-9, 60

PARAMETERS = "source string, source_size long, target double, tilt double, shift double"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order(source: str | None) -> tuple[bool, str]:
    """By code point, null last."""
    return source is None, source or ""


def weighted_targets(sizes: dict[str | None, int], weights: Sequence[float], most: float = MOST) -> dict[str | None, float]:
    """All words shared out by the weights, which repeat over the ordered sources.

    A share stops at ``most`` times its source's size; what is above is shared by weight among the others.
    """
    ranked = sorted(sizes, key=order)
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(ranked)}
    targets: dict[str | None, float] = {}
    left, open_ = float(sum(sizes.values())), ranked
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > most * sizes[s]]
        if not full:
            targets |= {s: share * weight[s] for s in open_}
            break
        for s in full:
            targets[s] = most * sizes[s]
            left -= targets[s]
        open_ = [s for s in open_ if s not in targets]
    return targets


def _tilted(base: Column, tilt: Column, most: float) -> Column:
    return F.least(F.lit(most), base * F.exp(tilt))


def _joined(documents: DataFrame, parameters: DataFrame, source: str) -> DataFrame:
    """``parameters`` has a row for each source, ``MAX_SOURCES`` at most, so it can go to every task."""
    right = parameters.select(F.struct("*").alias("__mix"))
    return documents.join(F.broadcast(right), documents[source].eqNullSafe(F.col("__mix.source")), "left")


def _multipliers(cells: DataFrame, targets: dict[str | None, float], most: float) -> dict[str | None, float]:
    """Newton's iterations for the dual. ``cells`` has the words of each source and base rate."""
    spark = cells.sparkSession
    low, high = dict.fromkeys(targets, -50.0), dict.fromkeys(targets, 50.0)
    tilt = {s: 0.0 if t > 0 else low[s] for s, t in targets.items()}
    moving = {s for s, t in targets.items() if t > 0}
    for _ in range(STEPS):
        if not moving:
            break
        now = spark.createDataFrame([(s, tilt[s]) for s in moving], "source string, tilt double")
        joined = cells.join(F.broadcast(now.select(F.struct("*").alias("m"))), cells["source"].eqNullSafe(F.col("m.source")))
        rate = _tilted(F.col("base"), F.col("m.tilt"), most)
        sums = joined.groupBy(cells["source"]).agg(
            F.sum(F.col("words") * rate).alias("taken"),
            F.sum(F.when(rate < most, F.col("words") * rate).otherwise(0.0)).alias("slope"),
            F.min(F.when(F.col("base") > 0, F.col("base"))).alias("least"),
        ).collect()  # a row for each source
        for source, taken, slope, least in sums:
            off = taken - targets[source]
            if abs(off) <= TOLERANCE * targets[source]:
                moving.discard(source)
                continue
            (high if off > 0 else low)[source] = tilt[source]
            if least is not None:  # above this, every rate is at its limit
                high[source] = min(high[source], math.log(most / least))
            step = tilt[source] - off / slope if slope > 0 else math.inf
            if not low[source] < step < high[source]:
                step = (low[source] + high[source]) / 2
            if high[source] - low[source] < 1e-15:
                moving.discard(source)
            tilt[source] = step
    return tilt


def balance(
    documents: DataFrame, weights: Sequence[float], text: str = "text", source: str = "source", doc_id: str = "doc_id",
    base: Column | None = None, most: float = MOST,
) -> DataFrame:
    """For each source its words, target, multiplier and limit's shift: what ``copies`` needs.

    ``base`` is a rate that documents begin with, 1 by default. Sizes are counted once and stored.
    """
    slim = stored(documents.select(
        F.col(source).cast("string").alias("source"), words_in(F.col(text)).alias("words"),
        (F.lit(1.0) if base is None else base.cast("double")).alias("base"),
        draw(F.col(doc_id), F.col(source), words_in(F.col(text))).alias("draw"),
    ), "sizes")
    cells = slim.groupBy("source", "base").agg(F.sum("words").cast("double").alias("words"))
    totals = slim.groupBy("source").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {row["source"]: row["words"] for row in totals}
    targets = weighted_targets(sizes, weights, most)
    tilt = _multipliers(cells, targets, most)
    shift = _shifts(slim, targets, tilt, most)
    rows = [(s, sizes[s], targets[s], tilt[s], shift[s]) for s in sorted(sizes, key=order)]
    return documents.sparkSession.createDataFrame(rows, PARAMETERS)


def draw(doc_id: Column, source: Column, words: Column) -> Column:
    """A number from 0 to below 1 for each document, the same in every run."""
    return F.pmod(F.xxhash64(doc_id, source, words), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _shifts(slim: DataFrame, targets: dict[str | None, float], tilt: dict[str | None, float], most: float) -> dict[str | None, float]:
    """Where each source's limit must lie for its copies to hold the target's words.

    A copy more goes to documents whose draw less their rate's rest is below the limit. Two histograms of
    that difference, the second within one bin of the first, give the sums of words to choose from.
    """
    spark = slim.sparkSession
    start, before = dict.fromkeys(targets, -1.0), dict.fromkeys(targets, 0.0)
    parameters = spark.createDataFrame([(s, tilt[s]) for s in targets], "source string, tilt double")
    placed = _joined(slim, parameters, "source").select(
        slim["source"], "words", _tilted(F.col("base"), F.col("__mix.tilt"), most).alias("rate"), "draw"
    ).withColumn("whole", F.floor(F.col("rate"))).withColumn("gap", F.col("draw") - (F.col("rate") - F.col("whole")))
    whole = {r[0]: float(r[1]) for r in placed.groupBy("source").agg(F.sum(F.col("whole") * F.col("words"))).collect()}
    need = {s: targets[s] - whole.get(s, 0.0) for s in targets}
    size = 2.0
    for level in range(2):
        size /= BINS
        ranges = spark.createDataFrame([(s, start[s]) for s in targets], "source string, start double")
        bins = _joined(placed, ranges, "source").select(
            placed["source"], "words", F.floor((F.col("gap") - F.col("__mix.start")) / F.lit(size)).alias("bin"),
        ).filter((F.col("bin") >= 0) & (F.col("bin") < BINS))
        sums = bins.groupBy("source", "bin").agg(F.sum("words").alias("words"))
        lists = sums.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("bin", "words"))).alias("bins"))
        for source, found in lists.collect():  # BINS x sources at most
            total, place = before[source], found[-1]["bin"] + 1
            for number, words in found:
                if total + words >= need[source]:
                    nearer = total + words - need[source] < need[source] - total
                    place = number + 1 if level and nearer else number
                    break
                total += words
            start[source], before[source] = start[source] + place * size, total
    return start


def copies(
    documents: DataFrame, parameters: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    base: Column | None = None, most: float = MOST, into: str = "mix",
) -> DataFrame:
    """All columns of ``documents`` and ``into``, a ``struct<size, source_size, target, rate, copies>``."""
    words = words_in(F.col(text))
    rate = _tilted(F.lit(1.0) if base is None else base.cast("double"), F.col("__mix.tilt"), most)
    rest = draw(F.col(doc_id), F.col(source), words) - (rate - F.floor(rate))
    count = F.least(F.lit(int(most)).cast("long"), F.floor(rate) + (rest < F.col("__mix.shift")).cast("long"))
    return _joined(documents, parameters, source).select(*[documents[c] for c in documents.columns if c != into], F.struct(
        words.alias("size"), F.col("__mix.source_size").alias("source_size"), F.col("__mix.target").alias("target"),
        rate.alias("rate"), F.when(words > 0, count).otherwise(0).alias("copies"),
    ).alias(into))
