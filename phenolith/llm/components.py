"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is a minimum per vertex (combined before the shuffle) and one join; edges are written after each,
so a lost executor costs one round. A round never collects a vertex's neighbours. Rounds end as soon as all
edges are stars around their smallest vertex, which edges from hubs often are from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each vertex's larger (large star) or smaller (small star) neighbours to its smallest one."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        moved = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    moved = moved.where(F.col("u") != F.col("v"))
    # repeats that a large star leaves go with the small star's
    return moved if large else moved.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every vertex either has one edge to a smaller vertex, or edges from larger ones only."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("down")))
    seen = ends.groupBy("x").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return seen.where("down > 1 or (down = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """vertex, component (the smallest vertex reachable) of every vertex of ``edges`` (u, v: long)."""
    edges = materialise(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        if _settled(edges):
            break
        edges = materialise(_star(_star(edges, True), False), "edges")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
