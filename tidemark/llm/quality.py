"""Quality of documents by gradient-boosted trees over counts of their texts.

Every text becomes a row of ``STATISTICS``: lengths, shares of kinds of characters, how words and lines
repeat, how words begin and end. Each statistic is cut into at most ``BINS`` bins at quantiles of the labelled
rows. Trees are grown level by level: sums of gradients and second derivatives by leaf, statistic and bin give the
best cut of every leaf. The trees then lie in flat arrays, and all rows of a batch walk down together, a
level a step.

The trees are fitted in one task to ``MAX_ROWS`` labelled documents at most, the ones whose ids have the least
hashes; fewer are all taken. That bound is the operator's one sample: statistics and scores are of
whole texts of all documents. Without any label every text has the score 0.5.

Defined results: a null text counts as the empty one, whose statistics are zeros; it gets the trees' score as any
other. Labels that are null, or whose document isn't there or has a null id, teach nothing. Of several labels of a
document, and of rows that share an id, each counts by its weight. Each input row is returned. Ties between cuts go to the first
statistic and the lowest bin, so the trees don't depend on the order of rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored

#: Labelled rows that trees are fitted to, at most.
MAX_ROWS = 40_000
BINS, TREES, DEPTH = 64, 120, 4
#: Each tree's part, what is added to a leaf's second derivatives, the least of them in a leaf, and the least gain of a cut.
RATE, PENALTY, LEAST_WEIGHT, LEAST_GAIN = 0.1, 1.0, 0.2, 1e-6
#: Texts in one Arrow batch.
BATCH = 256

STATISTICS = (
    "characters", "words", "lines", "word length", "word length spread", "line length", "upper", "lower", "digits", "blanks",
    "points", "marks", "symbols", "other letters", "entropy", "distinct words", "commonest word", "distinct pairs",
    "repeated lines", "commonest line", "upper words", "capital words", "letterless words", "marked ends", "doubled marks",
    "ended lines", "longest word", "short words", "links",
)


def _kinds() -> np.ndarray:
    """For each byte its kind: upper, lower, digit, blank, point, mark, symbol, part of another letter."""
    kind = np.full(256, 7)
    for b in range(128):
        c = chr(b)
        kind[b] = 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 if c.isspace() else (
            4 if c in ".,;:'\"()-" else 5 if c in "!?" else 6)
    return kind


KINDS = _kinds()


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(data, minlength=256)
    kinds = np.bincount(KINDS, count, 8) / len(data)
    share = count[count > 0] / len(data)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n, rows = max(len(words), 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    often, by_line = Counter(words), Counter(lines)
    ends = sum(k for w, k in often.items() if not w[-1].isalnum() and w[-1] not in ".,;:")
    doubled = sum(k for w, k in often.items() if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum())
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(len(lines)),
        float(sizes.mean()), float(sizes.std()), math.log1p(len(text) / rows), *kinds.tolist(), float(-(share * np.log2(share)).sum()),
        len(often) / n, max(often.values(), default=0) / n, len(set(zip(words, words[1:], strict=False))) / n,
        1 - len(by_line) / rows, max(by_line.values(), default=0) / rows,
        sum(k for w, k in often.items() if len(w) > 1 and w.isupper()) / n, sum(k for w, k in often.items() if w[0].isupper()) / n,
        sum(k for w, k in often.items() if not any(c.isalpha() for c in w)) / n, ends / n, doubled / n,
        sum(k for line, k in by_line.items() if line.rstrip()[-1] in ".!?:\"'") / rows, math.log1p(float(sizes.max())),
        float((sizes < 3).mean()), sum(k for w, k in often.items() if "://" in w or "@" in w) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """Binary trees of equal depth, flattened: node k of a tree has the children 2k+1 and 2k+2.

    ``feature`` and ``border`` have a row for each tree with its inner nodes, ``value`` with its leaves. A row goes
    left where its statistic is at most the border; nodes that weren't cut send all left.
    """

    base: float
    feature: np.ndarray
    border: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, border, value in zip(self.feature, self.border, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > border[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def borders(column: np.ndarray) -> np.ndarray:
    """Where a statistic is cut: between neighbouring values, at quantiles where there are many."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="lower"))
    return values[:-1]


def grown(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Trees fitted to rows of statistics, their labels 0 and 1 and weights, by sums over bins."""
    x, y, weight = x[weight > 0], y[weight > 0], weight[weight > 0]
    cuts = [borders(column) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T, strict=True)], 1)
    offset = np.arange(x.shape[1]) * BINS
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    base = math.log(((y * weight).sum() + 1) / (((1 - y) * weight).sum() + 1))
    margin, feature, border, value = np.full(len(y), base), [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        picked, at = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = (1 << level) - 1, 1 << level
            place = ((node - first)[:, None] * (BINS * x.shape[1]) + offset + binned).reshape(-1)
            size = width * BINS * x.shape[1]
            sums = [
                np.bincount(place, np.repeat(w, x.shape[1]), size).reshape(width, x.shape[1], BINS) for w in (g, h)
            ]
            left, right = zip(*((s.cumsum(2), s.sum(2, keepdims=True) - s.cumsum(2)) for s in sums), strict=True)
            gain = left[0] ** 2 / (left[1] + PENALTY) + right[0] ** 2 / (right[1] + PENALTY)
            whole = sums[0].sum(2, keepdims=True) ** 2 / (sums[1].sum(2, keepdims=True) + PENALTY)
            enough = (left[1] >= LEAST_WEIGHT) & (right[1] >= LEAST_WEIGHT)
            # Rounded, so that sums in another order of rows choose the same cut.
            gain = np.where(enough, np.round(gain - whole, 9), 0.0).reshape(width, -1)
            best = gain.argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, best[k]] > LEAST_GAIN and b < len(cuts[f]):
                    picked[first + k], at[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(x)), picked[node]] > at[node])
        leaf = node - inner
        value.append(-RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + PENALTY))
        margin += value[-1][leaf]
        feature.append(picked)
        border.append(at)
    return Trees(base, np.array(feature), np.array(border), np.array(value))


def measured(text: Column) -> Column:
    """The statistics of each text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<double>").asNondeterministic()(text)


def chosen_labels(documents: DataFrame, labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    """``(id, no, yes)``: how often documents are labelled 0 and 1, for ``rows`` of the documents at most."""
    own = labels.select(F.col(doc_id).cast("string").alias("id"), F.col(label).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IN (0, 1)"
    )
    own = own.groupBy("id").agg(F.count_if(F.col("label") == 0).alias("no"), F.count_if(F.col("label") == 1).alias("yes"))
    own = stored(own.join(documents.select(F.col(doc_id).cast("string").alias("id")), "id", "left_semi"), "labels")
    taught = own.count()
    order = F.xxhash64("id")
    if taught > rows:
        # Few more than needed have least hashes, so that few are sorted.
        own = own.filter(F.shiftrightunsigned(order, 1) < min((1 << 63) - 1, int((1 << 63) * (1.2 * rows + 1000) / taught)))
    return own.orderBy(order, "id").limit(rows)


def learn(
    documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", rows: int = MAX_ROWS,
) -> Trees | None:
    """Trees for the labels ``(doc_id, label)``; None if none of them is of a document."""
    small_batches(documents.sparkSession, BATCH)
    own = chosen_labels(documents, labels, doc_id, label, rows)  # no more than ``rows``, so it may be sent to all tasks
    given = documents.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    known = given.join(F.broadcast(own), "id").select("id", measured(F.col("text")).alias("x"), "no", "yes")
    # Equal rows are one row with a weight.
    known = known.groupBy("id", "x").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    sample = known.orderBy(F.xxhash64("id"), "id", "x").limit(rows)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if sum(map(len, parts)):
            all_ = pd.concat(parts).sort_values("id", kind="stable")
            x, w = np.stack(all_["x"].to_numpy()), all_[["no", "yes"]].to_numpy(np.float64)
            trees = grown(np.concatenate([x, x]), np.repeat([0.0, 1.0], len(x)), w.T.reshape(-1))
            yield pd.DataFrame({
                "base": [trees.base], **{n: [getattr(trees, n).reshape(-1)] for n in ("feature", "border", "value")},
            })

    found = sample.mapInPandas(fit, "base double, feature array<long>, border array<double>, value array<double>").first()
    if found is None:
        return None
    return Trees(found["base"], *(np.array(found[n]).reshape(TREES, -1) for n in ("feature", "border", "value")))


def score(documents: DataFrame, trees: Trees | None, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``documents`` but ``into``, and ``into``: how likely a text's label is 1."""
    small_batches(documents.sparkSession, BATCH)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if trees is None:
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(trees.scores(np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    found = F.pandas_udf(run, "double").asNondeterministic()  # so that it is computed once where it is used twice
    return documents.withColumn(into, found(F.col(text)))
