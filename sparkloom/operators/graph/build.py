"""Making node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ...scratch import Scratch
from ..joins import join_group_rows

# Fixed values of the arithmetic hash: a prime modulus and multipliers below
# 2**29, so that every product stays inside a signed 64-bit integer.
MODULUS = 2_147_483_647
FACTORS = (469_762_049, 167_772_161, 377_487_361)

MEETING = 4  # free places that meet in a group, as an expected number
ROUNDS = 8


def normalize_edges(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Half-edges of the undirected simple graph behind the pairs ``(a, b)``.

    Drops nulls, self-loops and duplicates in either direction, then mirrors
    every pair. Duplicates go first, so only half of the result is shuffled.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    pairs = (
        edges.filter(F.col(a) != F.col(b))
        .select(low.cast("long").alias("u"), high.cast("long").alias("v"))
        .distinct()
    )
    both = F.array(
        F.struct(F.col("u").alias("src"), F.col("v").alias("dst")),
        F.struct(F.col("v").alias("src"), F.col("u").alias("dst")),
    )
    return pairs.select(F.inline(both))


def nodes_of(df: DataFrame, id: str = "id") -> DataFrame:
    """Uncoloured nodes, one per distinct id."""
    return (
        df.filter(F.col(id).isNotNull())
        .select(F.col(id).cast("long").alias("id"))
        .distinct()
        .withColumn("color", F.lit(-1))
    )


def edges_from_shared_key(df: DataFrame, *, key: str, item: str) -> DataFrame:
    """Half-edges that link each item to the smallest item under the same key.

    Items sharing a key become connected with one edge per row instead of one
    per pair, so a key that holds a third of all rows adds a third of all
    edges and not their square. The smallest item is found with a combining
    group-by; the join back may split a hot key.
    """
    rows = df.select(key, item).filter(F.col(key).isNotNull() & F.col(item).isNotNull())
    hubs = rows.groupBy(key).agg(F.min(item).alias("hub"))
    linked = join_group_rows(rows, hubs, key)
    return normalize_edges(linked, "hub", item)


def generate_graph(
    spark: SparkSession, n: int, max_degree: int, seed: int = 123, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """A pseudo-random simple graph on ids ``0..n-1`` with no degree above ``max_degree``.

    A node has ``max_degree`` places for links. In each round all free places are
    dealt to groups of about four by a hash of node, place and round, and
    neighbours in the hashed order of a group are linked, so any two ids can meet.
    A place takes part in one pair at most, so degrees stay within the limit.
    Pairs of a node with itself and pairs that exist leave their places free for
    the next round; a round settles about seven places in eight. It ends after
    ``rounds``, or when a single node has places left, so of a sparse graph nearly
    all nodes reach the limit.

    Each round is written to the shared folder; the driver sees two counts of it.
    """
    if n <= 0:
        raise ValueError("the number of nodes must be positive")
    if max_degree < 0:
        raise ValueError("the maximum degree must not be negative")
    scratch = Scratch(spark, "generate")
    limit = min(max_degree, n - 1)
    free = spark.range(n).select("id", F.lit(limit).cast("long").alias("free")).where("free > 0")
    linked = spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))
    for number in range(rounds):
        facts = free.agg(F.count("*").alias("nodes"), F.sum("free").alias("places")).first()
        if facts["nodes"] < 2:
            break
        met = scratch.write(_met(free, facts["places"], seed, number), f"met{number}")
        # Late rounds meet few pairs, which Spark may send to the links instead.
        known = linked.join(met, ["u", "v"], "left_semi")
        fresh = scratch.write(met.join(known, ["u", "v"], "left_anti"), f"linked{number}")
        used = fresh.select(F.explode(F.array("u", "v")).alias("id")).groupBy("id").count()
        rest = F.col("free") - F.coalesce("count", F.lit(0))
        free = free.join(used, "id", "left").select("id", rest.alias("free")).where("free > 0")
        free = scratch.write(free, f"free{number}")
        linked = linked.union(fresh)
    both = F.array(
        F.struct(F.col("u").alias("src"), F.col("v").alias("dst")),
        F.struct(F.col("v").alias("src"), F.col("u").alias("dst")),
    )
    return spark.range(n).withColumn("color", F.lit(-1)), linked.select(F.inline(both))


def _met(free: DataFrame, places: int, seed: int, number: int) -> DataFrame:
    """Distinct pairs ``u < v`` of nodes whose free places meet in a round."""
    turn = seed % MODULUS + 2 * number
    groups = max(1, places // MEETING)
    stubs = free.select("id", F.explode(F.sequence(F.lit(1).cast("long"), "free")).alias("place"))
    mixed = stubs.select("id", "place", _dealt(turn).alias("a"), _dealt(turn + 1).alias("b"))
    for _ in range(2):
        mixed = mixed.select("id", "place", _fifth("a").alias("a"), _fifth("b").alias("b"))
    dealt = mixed.withColumn("group", F.pmod(F.col("a") * MODULUS + F.col("b"), F.lit(groups)))
    order = Window.partitionBy("group").orderBy("b", "a", "id", "place")
    other = F.lead("id").over(order)
    rows = dealt.select("id", other.alias("other"), F.row_number().over(order).alias("nr"))
    return (
        rows.where("nr % 2 = 1 AND id <> other")
        .select(F.least("id", "other").alias("u"), F.greatest("id", "other").alias("v"))
        .distinct()
    )


def _dealt(turn: int) -> Column:
    """A number below the modulus from node, place and turn; ids of any size count whole."""
    p, (fa, fb, fc) = F.lit(MODULUS), FACTORS
    high = F.pmod(F.shiftright("id", 31) + F.lit(turn), p)
    return F.pmod(F.pmod("id", p) * fa + F.pmod("place", p) * fb + high * fc, p)


def _fifth(name: str) -> Column:
    """The fifth power and a shift, which permute the numbers below the modulus."""
    x, p = F.col(name), F.lit(MODULUS)
    square = F.pmod(x * x, p)
    return F.pmod(F.pmod(square * square, p) * x + FACTORS[0], p)
