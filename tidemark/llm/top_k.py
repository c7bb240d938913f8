"""Exact top-k search by MaxScore over integer vectors.

A vector's components are its terms: the posting of a term holds each vector's value there. For one
query a term's score lies between two bounds within a shard; the difference is the term's reach. Terms
are split by reach into essential ones and those that together stay below the k-th best score known so
far. Essential postings are traversed for all vectors of the shard. The others are
probed, the widest reach first, only for vectors that can still compete. Shards' results are merged by
score and id.

One shard is searched first; each query's k-th best there is the score that all other shards start from.
Every query meets every shard, in blocks of bounded size. Where doubles don't hold every sum exactly, each vector's
bound is widened by what rounding may have changed, and what still competes is scored by whole numbers of any length.

Defined results: a row whose vector is null, or holds a null or non-finite component, or that has no id, takes no
part. A score that no long holds is returned as the largest or smallest one. Of rows that share an id, the smallest vector is the id's. A missing component
counts as 0, so an empty vector scores 0. Ties go to the smaller id. If there are fewer than k others,
all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Vectors of a shard and queries of a block, on average.
SHARD, BLOCK = 8192, 1024
#: Terms that are probed between two looks at what still competes.
PROBE = 8
#: Doubles hold all whole numbers up to this one.
EXACT, LONG = 1 << 53, 1 << 63


def whole_values(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` of every component as doubles, or null if one isn't a finite number."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(F.when(F.abs(x) < EXACT, x)).cast("double")).otherwise(x))
    return F.when(fine, whole)


def matrix(values: pd.Series, terms: int) -> np.ndarray:
    found = np.zeros((len(values), terms), np.float64)
    for row, value in zip(found, values, strict=True):
        row[:len(value)] = value
    return found


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers of any length."""
    asked = [int(v) for v in query]
    return np.array([sum(int(v) * q for v, q in zip(row, asked, strict=True)) for row in vectors.tolist()], object)


def best_of_shard(
    vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, query_id: int, k: int, low: np.ndarray, high: np.ndarray,
    floor: float | None = None, exact: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best for one query. Postings' smallest and largest values are ``low`` and ``high``.

    No result may fall below ``floor``, if it is known. ``exact`` says that doubles hold all sums.
    """
    alive = np.flatnonzero(ids != query_id)
    ends = query * low, query * high
    reach = np.abs(ends[1] - ends[0])
    order = np.argsort(-reach, kind="stable")
    # What the terms from each place on can add at most.
    rest = np.append(np.cumsum(np.maximum(*ends)[order][::-1])[::-1], 0.0)
    slack = np.zeros(len(vectors))
    if not exact:
        unit = (len(query) + 4) * 2.0**-52
        slack = unit * (np.abs(vectors) @ np.abs(query)) + unit * np.maximum(*np.abs(ends)).sum()
    if len(alive) > k:
        # Essential terms go up to where the others together stay below the k-th best; without one, to half of all reach.
        below = np.flatnonzero(rest < floor) if floor is not None else []
        at = int(below[0]) if len(below) else int(np.searchsorted(np.cumsum(reach[order]), reach.sum() / 2)) + 1
        at = min(max(at, 1), len(order))
        score = (vectors[:, order[:at]] @ query[order[:at]])[alive]
        # The most promising so far, scored in full, give a k-th best that no result may fall below.
        seeds = alive[np.argpartition(-score, k - 1)[:k]]
        worst = (vectors[seeds] @ query - slack[seeds]).min()
        worst = worst if floor is None else max(worst, floor)
        while True:
            keep = ~(score + rest[at] + slack[alive] < worst)  # sums beyond all doubles decide nothing
            alive, score = alive[keep], score[keep]
            if at == len(order):
                break
            probed = order[at:at + PROBE]
            score = score + vectors[np.ix_(alive, probed)] @ query[probed]
            at += len(probed)
    score = vectors[alive] @ query if exact else exact_scores(vectors[alive], query)
    best = np.array(sorted(range(len(alive)), key=lambda i: (-score[i], ids[alive[i]]))[:k], int)
    return alive[best], score[best]


def top_k(table: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k largest inner products of each query row with all other rows."""
    given = table.select(
        F.col(vec_id).cast("long").alias("id"), whole_values(F.col(vector), scale).alias("values"), is_query.alias("is_query")
    ).dropna(subset=["id", "values"])
    rows = stored(given.groupBy("id").agg(F.min("values").alias("values"), F.bool_or("is_query").alias("is_query")), "values")
    terms, total, asked = rows.agg(F.max(F.size("values")), F.count("*"), F.count_if("is_query")).first()
    shards, blocks = max(1, -(-total // SHARD)), max(1, -(-asked // BLOCK))
    shard, block = F.pmod(F.xxhash64("id"), F.lit(shards)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (shards, blocks)]

    def search(key: tuple, here: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(here) and len(asked):
            ids, postings, wanted = here["id"].to_numpy(), matrix(here["values"], terms), matrix(asked["values"], terms)
            exact = np.abs(postings).max(initial=0) * np.abs(wanted).max(initial=0) * terms < EXACT
            low, high = (postings.min(0), postings.max(0)) if terms else (np.zeros(0), np.zeros(0))
            floors = [None if f is None or f != f else float(f) for f in asked["floor"].tolist()]
            for query_id, query, floor in zip(asked["id"].tolist(), wanted, floors, strict=True):
                place, score = best_of_shard(postings, ids, query, query_id, k, low, high, floor, exact)
                score = [min(max(int(x), -LONG), LONG - 1) for x in score.tolist()]
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[place], "score": np.array(score, np.int64)}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(found) if found else empty

    def searched(own: Column, floors: DataFrame | None) -> DataFrame:
        """The best of the shards that ``own`` picks."""
        # Both sides come from one table, so their columns are named anew.
        vectors = rows.select(F.col("id").alias("id"), F.col("values").alias("values"), shard.alias("shard"), every[1].alias("block"))
        queries = rows.filter("is_query").select(
            F.col("id").alias("id"), F.col("values").alias("values"), every[0].alias("shard"), block.alias("block")
        )
        queries = queries.withColumn("floor", F.lit(None).cast("double")) if floors is None else queries.join(floors, "id", "left")
        keys = ["shard", "block"]
        return vectors.filter(own).groupBy(*keys).cogroup(queries.filter(own).groupBy(*keys)).applyInPandas(
            search, "query_id long, vec_id long, score long"
        )

    first = stored(searched(F.col("shard") == 0, None), "first-shard")
    merged = first
    if shards > 1:
        # A little below the score, for a double may not hold it; a query with fewer than k rows there has no floor.
        least = F.min("score").cast("double")
        floors = first.groupBy(F.col("query_id").alias("id")).agg((least - F.abs(least) * 2.0**-50).alias("floor"), F.count("*").alias("n"))
        merged = first.union(searched(F.col("shard") > 0, floors.filter(F.col("n") == k).select("id", "floor")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
