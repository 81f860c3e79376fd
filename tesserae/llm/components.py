"""Connected components of an edge table, by alternating large and small stars; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star step over edges (u, v), u > v."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node that it reaches. Loops and repeats don't matter.

    Every round is written to the shared folder. The number of rounds grows with the logarithm of the graph.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = staged(_stars(now), "stars")
        was, mark = mark, _mark(now)
        if mark == was:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
