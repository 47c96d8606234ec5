"""Connected components by alternating large and small stars, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met_by, release, stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node is linked to its smallest neighbour. ``n``: how many edges."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(met_by(least, n), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame, n: int) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    over = down.join(met_by(least, n), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return over.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _sum(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and label (the smallest node of its component) for edges (a, b).

    Nodes without an edge to another node do not appear. The number of rounds
    grows with the logarithm of the longest path.
    """
    now, before = stage(edges.where("a <> b").distinct(), "stars"), None
    mark = _sum(now)
    for _ in range(most_rounds):
        grown = stage(_small(_large(now, mark[0]), mark[0]), "stars")
        release(now)
        now, before, mark = grown, mark, _sum(grown)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    up = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return up.union(up.select(F.col("label").alias("node"), "label").distinct())
