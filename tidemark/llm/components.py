"""Connected components of links between ids, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


#: Links that one task reads in the next round: few links need few tasks.
ROWS = 100_000


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest of them and itself.

    In a large star, the neighbours above the node; in a small star, those below it and the node itself.
    The smallest neighbour is joined back, so the links of a node with very many can be split over tasks.
    """
    around = links if not large else links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = around.groupBy("a").agg(F.min("b").alias("low"))
    joined = around.join(lowest, "a")
    if large:
        found = joined.filter("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
    else:
        found = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            lowest.select("a", F.col("low").alias("b"))
        )
    return found.filter("a > b")


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in the links ``(a, b)``: the smallest id that it is connected with.

    Links may point either way and repeat; links from an id to itself are left out. Ids without links
    don't appear. After a few rounds every id is linked straight to its component's smallest.
    """
    now = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        now = checkpointed(_star(_star(now, large=True), large=False).distinct())
        # Done when every id points at one other, and none that is pointed at points further.
        ends = now.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
            now.select("b", F.lit(0), F.lit(1))
        )
        ends = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        open_, rows = ends.agg(F.count_if((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))), F.sum("out")).first()
        now = now.coalesce(max(1, (rows or 0) // ROWS))
        if not open_:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
