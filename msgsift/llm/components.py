"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.llm._common import drop_shared, shared_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m"))
    return both.join(low, F.col("u") == F.col("w")).where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    star = down.join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return star.unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v")))


def _is_star_forest(edges: DataFrame) -> bool:
    """Every child has one parent, and no parent is a child: the edges are (node, root)."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    per = ends.groupBy("n").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return per.where((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("parent") > 0))).isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node reachable.

    Every round is written to the shared folder and the one before it deleted. A hub's
    neighbours are combined before the shuffle, and its join is left to adaptive skew splitting.
    The rounds (about log2 of the longest chain) end as soon as the edges are stars: each star's
    centre is then the smallest node of its component.
    """
    current = shared_table(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    for _ in range(max_rounds):
        if _is_star_forest(current):
            leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return leaves.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        step = _small_star(_large_star(current)).where(F.col("u") != F.col("v")).distinct()
        following = shared_table(step, "components")
        drop_shared(current)
        current = following
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
