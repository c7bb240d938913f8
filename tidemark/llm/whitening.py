"""Vectors whitened by the covariance of their distinct values.

Equal vectors are grouped first. What is fitted counts each distinct vector once, or by how often it occurs
(``by_multiplicity``). Vectors are of integers, and are centred by the rounded mean before they are multiplied,
block by block; what rounding left of the mean is taken off exactly. Products are taken of 20-bit limbs in blocks
so short that doubles hold every sum, and are summed as decimals. So the covariance is exact, however
many rows there are and in whatever order they come, and its eigenvectors are the same in every run. Each distinct
vector is whitened once and joined back to its rows.

The driver gets a number for each two dimensions (and limbs), never rows.

Defined results: vectors that are null or hold null or non-finite entries are left out, and so are empty ones. Where
lengths differ, those of the most frequent length are the table (of equally frequent ones the longest) and the others
are left out. An entry that no long holds becomes the largest or smallest long. Components without variance
(``FLAT`` of the largest eigenvalue, as rounding leaves) have null whitened values and are left out of the identity
error; the error is null where there are none others. A deviation that no long holds is null. Repeated rows and null
ids are returned each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored

#: Bits of a limb, and rows multiplied together: doubles hold sums of as many products of two limbs.
LIMB, ROWS = 20, 4096
#: Largest share of the largest eigenvalue that counts as no variance.
FLAT = 1e-13
#: Dimensions at most; the covariance is solved on the driver.
MAX_DIMENSIONS = 4096
LONG = 1 << 63


def scaled(vector: Column, factor: int, plus: int) -> Column:
    """Entries as ``floor(factor * entry) + plus``; null for vectors that take no part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))

    def whole(c: Column) -> Column:
        x = F.floor(c.cast("double") * factor + 0.0)
        return F.when(c.cast("double") * factor >= 9.2e18, F.lit(LONG - 1)).when(
            c.cast("double") * factor <= -9.2e18, F.lit(-LONG)
        ).otherwise(x + plus).cast("long")

    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.transform(vector, whole))


@dataclass(frozen=True)
class Whitening:
    """What was fitted: vectors (or rows) ``n`` with exact ``sums``, components in rows by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def flat(self) -> np.ndarray:
        return self.eigenvalues <= FLAT * max(self.eigenvalues[0], 0.0)

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.eigenvalues]

    @property
    def centre(self) -> list[int]:
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``x`` less the rounded mean, as integers, and the part of the mean that rounding left."""
        rest = np.array([float(Fraction(s - self.n * c, self.n)) for s, c in zip(self.sums, self.centre, strict=True)])
        return subtracted(x, self.centre), rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        y, rest = self.centred(x)
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.flat, np.nan, 1 / np.sqrt(np.where(self.flat, 1.0, self.eigenvalues)))
        return ((y.astype(np.float64) - rest) @ self.components.T) * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of ``(n x - S)^2``, exact."""
        y = subtracted(x, self.centre)
        left = [s - self.n * c for s, c in zip(self.sums, self.centre, strict=True)]
        largest = max((abs(int(v)) for v in (y.max(), y.min())), default=0) if y.size else 0
        if (largest * self.n + self.n) ** 2 * y.shape[1] < LONG:
            own = y.astype(np.int64) * self.n - np.array(left, np.int64)
            return (own * own).sum(1).tolist()
        found = [sum((int(v) * self.n - s) ** 2 for v, s in zip(row, left, strict=True)) for row in y.tolist()]
        return [d if d < LONG else None for d in found]


def subtracted(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """``x`` less ``centre``; integers of any length where a long may not hold the result."""
    if not x.size or max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, centre)) < LONG:
        return x - np.array(centre, np.int64)
    return x.astype(object) - np.array(centre, object)


def products(y: np.ndarray) -> dict[int, np.ndarray]:
    """Exact ``y.T @ y`` in parts: for each power of two a matrix of whole numbers that it multiplies."""
    limbs, rest = [], y
    while True:
        low = rest & ((1 << LIMB) - 1)
        low = low - ((low >> (LIMB - 1)) << LIMB)  # between minus and plus half a limb
        limbs.append(low.astype(np.float64))
        rest = (rest - low) >> LIMB
        if not np.any(rest != 0):
            break
    found: dict[int, np.ndarray] = {}
    for k, left in enumerate(limbs):
        for m, right in enumerate(limbs):
            power = LIMB * (k + m)
            found[power] = found.get(power, 0) + (left.T @ right).astype(np.int64).astype(object)
    return found


def matrices(batches: Iterator[pd.Series]) -> Iterator[np.ndarray]:
    for column in batches:
        for start in range(0, len(column), ROWS):
            yield np.stack([np.asarray(v, np.int64) for v in column.iloc[start:start + ROWS]])


def fit(distinct: DataFrame, dimensions: int, components: int, vector: str = "x", times: Column | None = None) -> Whitening | None:
    """Fitted to the rows of ``distinct``, each as often as ``times`` says (once by default); None without rows."""
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"more than {MAX_DIMENSIONS} dimensions")
    times = F.lit(1).cast("long") if times is None else times
    weighted = distinct.select(F.col(vector).alias("x"), times.alias("w"))
    n = weighted.agg(F.sum("w")).first()[0]
    if not n:
        return None
    per_dimension = weighted.select(F.posexplode("x").alias("d", "v"), "w").groupBy("d").agg(
        F.sum(F.col("v").cast("decimal(38,0)") * F.col("w").cast("decimal(38,0)")).cast("decimal(38,0)").alias("s")
    )
    sums = [0] * dimensions
    for r in per_dimension.collect():
        sums[r["d"]] = int(r["s"])
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for weight, own in batch.groupby("w"):
                for x in matrices([own["x"]]):
                    for power, part in products(subtracted(x, centre)).items():
                        found[power] = found.get(power, 0) + part * int(weight)
        upper = np.triu_indices(dimensions)
        for power, part in found.items():
            yield pd.DataFrame({"power": power, "i": upper[0], "j": upper[1], "v": [str(v) for v in part[upper]]})

    parts = weighted.mapInPandas(gram, "power int, i int, j int, v string").groupBy("power", "i", "j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).cast("decimal(38,0)").alias("v")
    )
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    exact = [[0] * dimensions for _ in range(dimensions)]
    for r in parts.collect():
        exact[r["i"]][r["j"]] += int(r["v"]) << r["power"]
    covariance = np.zeros((dimensions, dimensions))
    for i in range(dimensions):
        for j in range(i, dimensions):
            covariance[i, j] = covariance[j, i] = float(Fraction(n * exact[i][j] - left[i] * left[j], n * n))
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    found = vectors[:, order].T
    # Of the two signs, the one whose largest entry is positive.
    found = found * np.where(found[np.arange(len(found)), np.abs(found).argmax(1)] < 0, -1.0, 1.0)[:, None]
    return Whitening(int(n), sums, np.ascontiguousarray(found), values[order], float(np.trace(covariance)))


def identity_error(whitened: DataFrame, n: int, keep: list[int], column: str = "whitened", times: Column | None = None) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over the components ``keep``."""
    if not keep:
        return None
    times = F.lit(1).cast("long") if times is None else times
    given = whitened.select(F.col(column).alias("z"), times.alias("w"))

    def summed(centre: np.ndarray | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(1)
            for batch in batches:
                if len(batch):
                    z, w = np.stack(batch["z"].to_numpy()).astype(np.float64)[:, keep], batch["w"].to_numpy(np.float64)
                    total = total + (w @ z if centre is None else ((z - centre) * w[:, None]).T @ (z - centre)).reshape(-1)
            yield pd.DataFrame({"k": np.arange(len(total)), "v": total})

        rows = given.mapInPandas(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
        return np.array([r["v"] for r in rows]) / n

    mean = summed(None)
    covariance = summed(mean).reshape(len(keep), len(keep))
    return float(np.abs(covariance - np.eye(len(keep))).max())


def whiten(
    vectors: DataFrame, entries: Column, components: int = 16, into: str = "white", by_multiplicity: bool = False,
) -> DataFrame:
    """All columns of ``vectors`` but ``into``, and ``into: struct<n, deviation, whitened, explained, identity_error>``.

    ``entries`` gives a row's vector of longs, or null. Rows without one are left out. ``whitened`` and ``explained``
    have an entry for each component.
    """
    small_batches(vectors.sparkSession, ROWS)
    names = [c for c in vectors.columns if c != into]
    given = vectors.select(F.struct(*[F.col(c) for c in names]).alias("row"), entries.alias("x")).filter("x IS NOT NULL")
    distinct = stored(given.groupBy("x").agg(F.count("*").alias("times")), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("times").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    shape = "x array<long>, times long, deviation long, whitened array<double>"
    fitted = None
    if usual is not None:
        distinct = distinct.filter(F.size("x") == usual["d"])
        times = F.col("times") if by_multiplicity else None
        fitted = fit(distinct, usual["d"], min(components, usual["d"]), times=times)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                own = batch.iloc[start:start + ROWS]
                x = np.stack([np.asarray(v, np.int64) for v in own["x"]])
                z = fitted.whitened(x)
                yield pd.DataFrame({
                    "x": own["x"].to_numpy(), "times": own["times"].to_numpy(),
                    "deviation": pd.array(fitted.deviations(x), "Int64"),
                    "whitened": [[None if v != v else v for v in row] for row in z.tolist()],
                })

    if fitted is None:
        white = distinct.limit(0).select("x", "times", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened"))
        error, n, explained = None, 0, []
    else:
        white = stored(distinct.mapInPandas(apply, shape), "whitened")
        keep = np.flatnonzero(~fitted.flat).tolist()
        error = identity_error(white, fitted.n, keep, times=times)
        n, explained = fitted.n, fitted.explained
    result = F.struct(
        F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(e) for e in explained]).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
    joined = given.join(white.select("x", result.alias("result")), "x")
    return joined.select(*[F.col("row")[c].alias(c) for c in names], F.col("result").alias(into))
