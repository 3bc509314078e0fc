"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each vertex under its least neighbour. Joins the least one back, so that no hub is gathered."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    hung = both.join(least, "u")
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, stage) -> DataFrame:
    """(v, root) for every vertex of `edges` (a, b); root is the least vertex of its component. Loops are ignored,
    so a vertex with loops only is not returned."""
    edges = stage(edges.filter("a != b").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        edges = stage(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("b").alias("root"))).distinct()
