"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the least node about it."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them. edges: a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node and root (its component's least node) of every node that has an edge. edges: a, b of one orderable type."""
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now, before = materialize(ordered.distinct(), "stars"), None
    for _ in range(rounds):
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
        now = materialize(_small(_large(now)), "stars")
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
