"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.store import fewer, held


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(id, root) for every end of the edges (u, v); the root is the smallest id of its component.

    Each round links all larger neighbours of a node to the smallest one, then all smaller ones,
    until every node hangs on its root; the number of rounds grows with the logarithm of the
    longest path. Rounds are written to the shared folder. ``most``: how many edges there are at
    most, where that is known; the steps run in as many tasks as the edges need.
    """
    first = _ordered(edges)
    now = held(first if most is None else fewer(first, most), "edges")
    while True:
        count, done = _state(now, most)
        if done:
            break
        most = 2 * count
        now = held(fewer(_small_star(fewer(_large_star(now, most), most), most), most), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )


def _state(edges: DataFrame, most: int | None) -> tuple[int, bool]:
    """How many edges there are, and whether every larger end has one and is no smaller end of another: all
    hang on their roots."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    found = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    found = found if most is None else fewer(found, 2 * most)
    count, open_ = found.agg(F.sum("up"), F.count_if(F.expr("up + down > 1 AND up > 0"))).first()
    return count or 0, not open_


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame, most: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = fewer(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), most)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, most: int) -> DataFrame:
    least = fewer(edges.groupBy("u").agg(F.min("v").alias("m")), most)
    down = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.withColumnRenamed("m", "v")).distinct()
