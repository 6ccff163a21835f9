"""Degrees, isolated nodes included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, degree)`` for every node; a node without edges has degree zero."""
    counted = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return (
        nodes.select("id")
        .join(counted, "id", "left")
        .select("id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))
    )


def degree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: number of nodes, largest and average degree."""
    return degrees(nodes, edges).agg(
        F.count(F.lit(1)).alias("node_count"),
        F.max("degree").alias("max_degree"),
        F.avg("degree").alias("average_degree"),
    )
