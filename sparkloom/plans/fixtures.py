"""Views of the test tables in the shapes the operators work on.

Each view exists twice, as a DataFrame and as SQL (in ``oracles.py``), with the
same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph

# Ids of nodes that the test change log adds start here.
NEW_NODES = 1_000_000_000
# Least quantity of a large order line.
LARGE = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their part: scored rows with a group, an album and features."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    order = F.col("l_orderkey").cast("string")
    shared = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("album"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("line"),
        F.when(shared, F.concat(order, F.lit(";"), F.col("l_suppkey").cast("string")))
        .otherwise(order)
        .alias("artists"),
        F.col("p_brand").alias("genre"),
        F.col("p_type").alias("kind"),
        (F.col("l_quantity") * 2).cast("int").alias("score"),
        (F.col("l_discount") * 10).alias("feature_a"),
        (F.col("l_tax") * 12.5).alias("feature_b"),
        (F.col("l_returnflag") == "R").alias("flag"),
        (60 + 2 * F.col("p_size")).cast("double").alias("tempo"),
        F.col("l_extendedprice").alias("duration"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`items` with missing and out-of-range values worked in."""
    line = F.col("line")
    return items(spark, sf_dir).select(
        "album",
        "part",
        "line",
        F.when(~((line == 4) & F.col("flag")), F.col("genre")).alias("genre"),
        F.when(line == 6, F.col("feature_a") + 1)
        .when(line != 7, F.col("feature_a"))
        .alias("feature_a"),
        F.when(line == 5, F.col("feature_b") - 0.5).otherwise(F.col("feature_b")).alias("feature_b"),
    )


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines credited to a supplier, to a brand, or to several names at once."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier")
    returned = F.col("l_returnflag") == "R"
    members = (
        F.when(
            returned & (F.col("l_linestatus") == "O"),
            F.concat("s_name", F.lit(" ; "), "p_brand", F.lit(";"), "p_type"),
        )
        .when(returned, F.concat("s_name", F.lit(";"), "p_brand"))
        .when(F.col("l_returnflag") == "A", F.col("s_name"))
        .otherwise(F.col("p_brand"))
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(members.alias("members"), (F.col("l_quantity") * 2).cast("int").alias("score"))
    )


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nodes_of(table(spark, sf_dir, "part"), "p_partkey")


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts linked to the smallest part on the same order."""
    lines = table(spark, sf_dir, "lineitem")
    return graph.edges_from_shared_key(lines, key="l_orderkey", item="l_partkey")


def large_line_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`part_edges` of the order lines with the largest quantities, a sparse graph."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= LARGE)
    return graph.edges_from_shared_key(lines, key="l_orderkey", item="l_partkey")


def striped_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wrong colouring on purpose: the part number modulo three."""
    return part_nodes(spark, sf_dir).select("id", (F.col("id") % 3).cast("int").alias("color"))


def _with_ends(spark: SparkSession, sf_dir: str, order: Column) -> DataFrame:
    """``seq, low, high``: per supplier, the smallest and largest part of one of its orders."""
    lines = table(spark, sf_dir, "lineitem")
    chosen = lines.groupBy(F.col("l_suppkey").alias("seq")).agg(order.alias("o"))
    ends = lines.groupBy(F.col("l_orderkey").alias("o")).agg(
        F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high")
    )
    return chosen.join(ends, "o").drop("o")


def local_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log with one change per supplier, most of them far from each other.

    By supplier number, it removes the edge between the smallest and largest part of
    the order of its dearest line, adds a node linked to them, links them, or removes
    the largest.
    """
    dearest = F.max_by("l_orderkey", F.struct("l_extendedprice", -F.col("l_orderkey")))
    turn, null = F.col("seq") % 4, F.lit(None).cast("bigint")
    return _with_ends(spark, sf_dir, dearest).select(
        "seq",
        F.when(turn == 0, "REMOVE_EDGE")
        .when(turn == 1, "ADD_NODE")
        .when(turn == 2, "ADD_EDGE")
        .otherwise("REMOVE_NODE")
        .alias("type"),
        F.when(turn == 1, F.col("seq") + NEW_NODES).when(turn == 3, F.col("high"))
        .otherwise(F.col("low")).alias("a"),
        F.when(turn.isin(0, 2), F.col("high")).otherwise(null).alias("b"),
        F.when(turn == 1, F.array("low", "high")).alias("neighbors"),
    )


def part_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log with one change per supplier, around its first order.

    By supplier number, it removes the edge between that order's smallest and
    largest part, adds a node linked to them and to a node that may not exist,
    links the smallest part to an added node, or removes the largest part.
    """
    seq, low, high = F.col("seq"), F.col("low"), F.col("high")
    turn = seq % 4
    null = F.lit(None).cast("bigint")
    return _with_ends(spark, sf_dir, F.min("l_orderkey")).select(
        "seq",
        F.when(turn == 0, "REMOVE_EDGE")
        .when(turn == 1, "ADD_NODE")
        .when(turn == 2, "ADD_EDGE")
        .otherwise("REMOVE_NODE")
        .alias("type"),
        F.when(turn == 1, seq + NEW_NODES).when(turn == 3, high).otherwise(low).alias("a"),
        F.when(turn == 0, high).when(turn == 2, seq - 1 + NEW_NODES).otherwise(null).alias("b"),
        F.when(turn == 1, F.array(low, high, seq - 4 + NEW_NODES, seq)).alias("neighbors"),
    )
