"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_group_rows
from ..scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    joined = join_group_rows(both, least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # u is the larger end of every edge here.
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    joined = join_group_rows(edges, least, "u").where("v <> least")
    moved = joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """``node, component`` for every node with an edge; the component is its smallest node.

    ``edges`` has columns ``u`` and ``v`` of one ordered type; direction, repeats
    and loops do not matter. Every round is written to the shared folder and
    shrinks the longest path by a constant factor; the driver sees two numbers
    per round. No edges give no rows.
    """
    oriented = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = scratch.write(oriented.distinct(), f"{name}_0")
    seen = None
    for number in range(1, 1_000_000):
        stars = _small_star(_large_star(current).where("u <> v"))
        current = scratch.write(stars, f"{name}_{number}")
        facts = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 2**40)).first()
        if facts == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = facts
