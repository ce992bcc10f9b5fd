"""Connected components by alternating large-star and small-star steps, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.llm.shared import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is hung on the smallest node around u."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (
        both.join(least, F.col("u") == F.col("w"))
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """u and every neighbour below u are hung on the smallest of them. Edges point from the larger node down."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    below = down.join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return below.union(least.select("w", "m")).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node reachable.

    NULL ends and self-links are ignored: such nodes do not appear. Stars with very many leaves are joined to their
    minimum after a map-side minimum, so no group is ever gathered in one task; adaptive joins split the hot side.
    The number of rounds grows with the logarithm of the longest chain.
    """
    now = scratch.table(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        following = scratch.table(_small_star(_large_star(now)), "stars")
        scratch.drop(now)
        now, before = following, state
        state = _state(now)
        if state == before:
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
