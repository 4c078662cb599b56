"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import joined_by_group, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree")))
    return (joined_by_group(both.where("v > u"), least, ["u"], "degree", "inner")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    return (joined.where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; root is the smallest node reached.

    Alternating large and small stars: each round hangs the neighbours of a node below the smallest
    one, and after a number of rounds that grows with the logarithm of the longest chain every
    component is a star. Rounds are cut by tables in the shared folder. Loops count as no edge.
    The smallest neighbours of nodes with very many are broadcast, so no hub fills one task.
    """
    stars = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                   .distinct())
    seen = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        stars = staged(_small_star(_large_star(stars)))
    return (stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            .unionByName(stars.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()))
