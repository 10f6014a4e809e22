"""Connected components by alternating large-star and small-star steps, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root), stored, for every node of the edges (u, v); root is the smallest node reachable. Self-loops are kept.

    It is done when the edges are stars: a node that points to a smaller one is pointed to by none and has one edge.
    """
    e = stored(edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    for _ in range(max_rounds):
        if _stars(e):
            break
        before, e = e, stored(_small(_large(e)))
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    ends = e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")))
    out = stored(ends.groupBy("node").agg(F.min("root").alias("root")))
    discard(e)
    return out


def _stars(e: DataFrame) -> bool:
    ends = e.filter("a <> b").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("p"))
    return ends.groupBy("p.x").agg(F.sum("p.up").alias("up"), F.max("p.down").alias("down")).filter("up > 1 OR up > 0 AND down > 0").isEmpty()


def _large(e: DataFrame) -> DataFrame:
    """Edges (a, b), some twice; _small makes them distinct."""
    both = e.select(F.col("a").alias("x"), F.col("b").alias("n")).unionByName(e.select(F.col("b").alias("x"), F.col("a").alias("n")))
    least = both.groupBy("x").agg(F.min("n").alias("m")).select("x", F.least("m", "x").alias("m"))
    return both.join(least, "x").filter("n > x OR n = m").select(F.greatest("n", "m").alias("a"), F.least("n", "m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
