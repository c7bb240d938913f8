"""Vectors that are near by cosine: int8 quantised tile products with exact error bounds.

Equal vectors stand for each other first, so only different ones are compared. Each is scaled to length
1 and quantised to int8; the length of what quantising left out is known for every vector, and bounds
how far a product of int8 vectors can be from the cosine. Tiles of int8 vectors are multiplied. Pairs
that the bound puts above or below the threshold are settled; only the others are computed from the
vectors themselves in double precision.

Which tiles meet: pivots are vectors of the table, and each vector lives in its nearest pivot's cell. It
visits the cells behind its own that can hold a vector near enough, by the triangle inequality of
angles, so nothing is lost. Cells and their visitors are split into tiles of bounded size.

A tile returns each vector's number of links and a forest that connects what is linked in it, never its
pairs.

Defined results: a vector that is null, empty, of length zero, or holds a null or non-finite component
links with nothing, and neither do vectors of different numbers of components. Of rows that share an id,
the smallest vector is the id's, and one row is returned. Rows without an id are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.components import components

#: Pivots at most: these go to every task. Vectors in a cell, on average, where that allows it.
MAX_PIVOTS, CELL = 1024, 4096
#: Vectors in a tile's two sides at most, on average.
RESIDENTS, VISITORS = 4096, 8192
#: Rows of a tile's product that are held at once.
STRIP = 512
#: Rounding of the products in single precision and of the bounds themselves.
SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Whether all components are numbers, and one isn't zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 values of unit vectors, their scales, lengths, and the lengths of what is left out."""
    scale = np.abs(unit).max(1) / 127
    values = np.rint(unit / scale[:, None])
    kept = values * scale[:, None]
    return values.astype(np.int8), scale, np.sqrt((kept**2).sum(1)), np.sqrt(((unit - kept) ** 2).sum(1))


def unit_rows(vectors: pd.Series) -> np.ndarray:
    rows = np.array(vectors.tolist(), np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Strips of the matrix that says which rows of two sides have a cosine of ``threshold`` or more."""
    a, scale_a, long_a, rest_a = quantised(left)
    b, scale_b, _, rest_b = quantised(right)
    b = b.T.astype(np.float32)  # sums of int8 products are whole numbers that single precision holds
    for start in range(0, len(left), STRIP):
        part = slice(start, start + STRIP)
        product = a[part].astype(np.float32) @ b
        product *= scale_a[part, None].astype(np.float32)
        product *= scale_b.astype(np.float32)
        widest = (rest_a[part] + long_a[part] * rest_b.max() + SLACK).max()
        yes = np.zeros(product.shape, bool)
        i, j = np.nonzero(product >= threshold - widest)
        bound = rest_a[start + i] + long_a[start + i] * rest_b[j] + SLACK
        sure = product[i, j] - bound >= threshold
        yes[i[sure], j[sure]] = True
        open_ = ~sure & (product[i, j] + bound >= threshold)
        i, j = i[open_], j[open_]
        for k in range(0, len(i), 1 << 16):
            x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            yes[x, y] = np.einsum("ij,ij->i", left[start + x], right[y]) >= threshold
        yield start, yes


def forest(hits: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a row and a column that connect what a matrix of links connects."""
    pairs, rows_left, columns_left = [], hits.any(1), hits.any(0)
    for seed in np.flatnonzero(rows_left):
        todo = [(seed, True)] if rows_left[seed] else []
        rows_left[seed] = False
        while todo:
            at, is_row = todo.pop()
            found = np.flatnonzero(hits[at] & columns_left if is_row else hits[:, at] & rows_left)
            (columns_left if is_row else rows_left)[found] = False
            pairs += [(at, k) if is_row else (k, at) for k in found.tolist()]
            todo += [(k, not is_row) for k in found.tolist()]
    return pairs


def _cells(vectors: DataFrame, threshold: float) -> DataFrame:
    """Each vector's home cell, and the cells that it visits."""
    spark, total = vectors.sparkSession, vectors.groupBy("size").count().collect()  # numbers of components
    pivots: dict[int, np.ndarray] = {}
    for size, count in total:
        wanted = max(1, min(MAX_PIVOTS, count // CELL))
        chosen = vectors.filter(F.col("size") == size).orderBy(F.xxhash64("id"), "id").limit(wanted)
        pivots[size] = unit_rows(chosen.select("vector").toPandas()["vector"])  # MAX_PIVOTS rows at most
    reach = math.acos(threshold) + 1e-7

    def angles(pdf: pd.DataFrame, size: int) -> np.ndarray:
        return np.arccos(np.clip(unit_rows(pdf["vector"]) @ pivots[size].T, -1, 1))

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for size, part in pdf.groupby("size"):
                angle = angles(part, size)
                yield part.assign(cell=angle.argmin(1), angle=angle.min(1))

    housed = stored(vectors.mapInPandas(home, "id long, members long, size int, vector array<double>, cell int, angle double"), "cells")
    extents = {
        (r["size"], r["cell"]): (r["radius"], r["n"])
        for r in housed.groupBy("size", "cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()
    }

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for size, part in pdf.groupby("size"):
                angle = angles(part, size)
                radius = np.array([extents.get((size, k), (-np.inf, 0))[0] for k in range(angle.shape[1])])
                near = (angle <= radius + reach) & (np.arange(angle.shape[1]) > part["cell"].to_numpy()[:, None])
                yield part.assign(cells=[np.flatnonzero(n).tolist() for n in near])

    seen = housed.mapInPandas(visit, housed.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", cells array<int>")
    return seen, extents


def _tiles(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(id, other, links)``: links counted by a tile, or with 0 a pair of its forest."""
    seen, extents = _cells(vectors, threshold)
    seen = stored(seen, "visits")
    guests = {
        (r["size"], r["cell"]): r["n"]
        for r in seen.select("size", F.explode("cells").alias("cell")).groupBy("size", "cell").agg(F.count("*").alias("n")).collect()
    }
    shape = [
        (size, cell, math.ceil(n / RESIDENTS), math.ceil((n + guests.get((size, cell), 0)) / VISITORS))
        for (size, cell), (_, n) in extents.items()
    ]
    if not shape:
        return seen.select("id", F.col("id").alias("other"), F.lit(0).cast("long").alias("links")).limit(0)
    shapes = F.broadcast(vectors.sparkSession.createDataFrame(shape, "size int, cell int, rows int, columns int"))
    plain = ["id", "members", "vector"]

    def deal(sides: DataFrame, own: str, other: str) -> DataFrame:
        """Every vector in one part of its own side, and once for each part of the other side."""
        dealt = sides.join(shapes, ["size", "cell"]).select(
            "size", "cell", F.pmod(F.xxhash64("id", F.lit(own)), F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), F.col("cell").alias("at"), "home", *plain,
        )
        return dealt.select(*[F.col(c).alias(c) for c in dealt.columns])  # both sides come from one table

    residents = deal(seen.withColumn("home", F.col("cell")), "rows", "columns")
    callers = seen.withColumn("home", F.col("cell")).withColumn("cell", F.explode(F.concat(F.array("cell"), F.col("cells"))))
    visitors = deal(callers, "columns", "rows")
    keys = ["size", "cell", "rows", "columns"]

    def multiply(key: tuple, here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"id": [], "other": [], "links": []}).astype("int64")]
        if len(here) and len(there):
            there = there.sort_values("id", ignore_index=True)
            ids, guests = here["id"].to_numpy(), there["id"].to_numpy()
            hits = np.zeros((len(here), len(there)), bool)
            for start, part in linked(unit_rows(here["vector"]), unit_rows(there["vector"]), threshold):
                hits[start:start + len(part)] = part
            # Vectors of one cell meet twice, so the smaller id's row has them.
            hits &= (there["home"] != there["at"]).to_numpy() | (ids[:, None] < guests)
            for own, other, matrix in ((here, there, hits), (there, here, hits.T)):
                some, met = matrix.any(1), matrix.any(0)
                count = matrix[np.ix_(some, met)].astype(np.float64) @ other["members"].to_numpy(np.float64)[met]
                found.append(pd.DataFrame({"id": own["id"][some], "other": own["id"][some], "links": count.astype(np.int64)}))
            if pairs := np.array(forest(hits), np.int64).reshape(-1, 2).T.tolist():
                found.append(pd.DataFrame({"id": ids[pairs[0]], "other": guests[pairs[1]], "links": 0}))
        return pd.concat(found)

    return residents.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInPandas(multiply, "id long, other long, links long")


def near_vectors(table: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every id: other vectors linked directly, and the smallest reachable id."""
    given = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).dropna(subset=["id"])
    rows = stored(given.groupBy("id").agg(F.min("vector").alias("vector")), "vectors")
    classes = stored(
        rows.filter(usable(F.col("vector"))).groupBy("vector").agg(
            F.min("id").alias("class"), F.count("*").alias("members"),
        ).withColumn("size", F.size("vector")), "classes",
    )
    member = rows.filter(usable(F.col("vector"))).join(classes.select("vector", "class"), "vector").select("id", "class")
    tiles = stored(_tiles(classes.select(F.col("class").alias("id"), "members", "size", "vector"), threshold), "tiles")
    counts = tiles.filter("id = other").groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "class")
    reached = components(tiles.filter("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    facts = (
        classes.select("class", "members")
        .join(counts, "class", "left")
        .join(reached.withColumnRenamed("id", "class"), "class", "left")
    )
    return rows.select("id").join(member.join(facts, "class"), "id", "left").select(
        "id",
        F.coalesce(F.col("members") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "class", "id").alias("component_id"),
    ).withColumn("kept", F.col("id") == F.col("component_id"))
