"""Greedy colouring in rounds.

In every round each uncoloured node proposes its smallest free colour. Of
neighbours proposing the same colour the one with the lowest id keeps it; a node
that sees its own proposal from any neighbour with a lower id waits for the next
round, even if that neighbour has to wait as well. The colours depend on a limit
``k`` only by failing when a proposal reaches it, so a single run without a limit
gives the same colouring, and the same smallest ``k``, as trying one ``k`` after
another.

Edges are written once, bucketed by source, so a round moves only per-node state
and the messages, which combine before their shuffle. A node whose edges are too
many for one task is spread over several slots of the bucketing. Each round's
state is written to the shared folder, its counts are taken on the way, and edges
between finished nodes are dropped as the rounds go on. The neighbour that comes
first always decides, so the rounds end by themselves; in id order they are as
many as the longest path of ascending ids needs, in hash order far fewer.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ...functions.colors import SMALLEST_FREE, smallest_free_color
from ...scratch import Scratch
from .slots import SLOT_EDGES, every_slot_sql, hub_slots, slot_of_edges
from .validate import UNCOLORED

# Multiplier and prime modulus of the order by hash.
HASH_FACTOR, HASH_MODULUS = 469_762_049, 2_147_483_647

# Half-edges per bucket of the written edge table, and so per task of a round.
BUCKET_EDGES = 1_000_000
MAX_BUCKETS = 50_000
# Below this size, dropping finished edges costs more than it saves.
COMPACT_EDGES = 5_000_000
# Share of the written half-edges with an open source at which finished ones are dropped.
COMPACT_SHARE = 0.7

PARTITIONS = "spark.sql.shuffle.partitions"

STATE = "id bigint, degree bigint, used array<int>, color int"


@dataclass(frozen=True)
class Coloring:
    """Result of :func:`color_graph`.

    ``colors(id, color)`` holds every node; ``state`` adds the degree and the
    round in which a node was coloured (0 for nodes that came coloured).
    """

    colors: DataFrame
    state: DataFrame
    best_k: int
    success: bool
    rounds: int
    candidate_fails: int


def is_colored(color: Column | str = "color") -> Column:
    """True for a set colour."""
    color = F.col(color) if isinstance(color, str) else color
    return F.coalesce(color > UNCOLORED, F.lit(False))


class _Edges:
    """The half-edges among uncoloured nodes, bucketed by source (and slot)."""

    def __init__(self, scratch: Scratch, slot_edges: int):
        self.scratch = scratch
        self.slot_edges = slot_edges
        self.version = 0
        self.session = scratch.spark
        self.partitions = self.session.conf.get(PARTITIONS)

    def store(self, edges: DataFrame, degrees: DataFrame, total: int, largest: int) -> None:
        """Write ``edges``; ``degrees(id, degree)`` covers their sources."""
        previous, self.version = self.version, self.version + 1
        limit = self.slot_edges
        self.total = total
        self.keys = ["src"]
        self.heavy = None
        if largest > limit:
            self.heavy = self.scratch.write(hub_slots(degrees, limit), f"heavy{self.version}")
            self.keys = ["src", "slot"]
            edges = slot_of_edges(edges, self.heavy)
        # Every task of a round takes memory for its sorts, so small graphs get few tasks. The
        # shuffles of a round are as wide as the bucketing, or they would move the edges.
        cores = self.session.sparkContext.defaultParallelism
        wanted = min(max(cores, ceil(total / BUCKET_EDGES)), MAX_BUCKETS)
        self.session.conf.set(PARTITIONS, wanted)
        self.table = self.scratch.write_bucketed(
            edges, f"edges{self.version}", self.keys, int(self.session.conf.get(PARTITIONS))
        )
        if previous:
            self.scratch.drop_table(f"edges{previous}")

    def heard_from(self, senders: str, value: str, condition: str = "true") -> str:
        """SQL for ``(id, received)``: the distinct ``value`` each node's neighbours send it."""
        if self.heavy is None:
            source, match = senders, "s.id = e.src"
        else:
            source, match = every_slot_sql(senders, "{heavy}"), "s.id = e.src AND s.slot = e.slot"
        return f"""
            SELECT e.dst AS id, collect_set(s.{value}) AS received
            FROM {{edges}} e JOIN {source} s ON {match}
            WHERE {condition} GROUP BY e.dst"""

    def run(self, sql: str, active: DataFrame) -> DataFrame:
        frames = {"edges": self.table, "active": active}
        if self.heavy is not None:
            frames["heavy"] = self.heavy
        return active.sparkSession.sql(sql, **frames)

    def close(self) -> None:
        self.session.conf.set(PARTITIONS, self.partitions)
        self.scratch.drop_table(f"edges{self.version}")


def hash_order(id: str) -> str:
    """SQL for a node's place in the order by hash; ties go by id."""
    return f"(({id}) % {HASH_MODULUS} * {HASH_FACTOR} % {HASH_MODULUS})"


# Whether the first end of an edge goes before the second.
PRIORITY = {
    "id": "e.src < e.dst",
    "hash": f"struct({hash_order('e.src')}, e.src) < struct({hash_order('e.dst')}, e.dst)",
}


def _round(active: DataFrame, edges: _Edges, priority: str = "id") -> DataFrame:
    """State of the active nodes after one round: coloured, or with more colours in use.

    One SQL text, since planning is most of the cost of a round over little data.
    """
    sql = f"""
        WITH proposing AS (
          SELECT id, degree, used, {SMALLEST_FREE} AS proposal FROM {{active}}
        ),
        heard AS ({edges.heard_from("proposing", "proposal", PRIORITY[priority])}),
        decided AS (
          SELECT p.id, degree, used,
                 CASE WHEN NOT coalesce(array_contains(received, proposal), false)
                      THEN proposal END AS color
          FROM proposing p LEFT JOIN heard h ON h.id = p.id
        ),
        told AS ({edges.heard_from("decided", "color", "s.color IS NOT NULL")})
        SELECT d.id, degree,
               CASE WHEN color IS NULL
                    THEN array_union(used, coalesce(received, CAST(array() AS array<int>)))
               END AS used,
               color
        FROM decided d LEFT JOIN told t ON t.id = d.id"""
    return edges.run(sql, active)


def color_graph(
    nodes: DataFrame,
    edges: DataFrame,
    k_max: int | None = None,
    max_rounds: int | None = None,
    slot_edges: int = SLOT_EDGES,
    compact_edges: int = COMPACT_EDGES,
    stored: bool = False,
    priority: str = "id",
) -> Coloring:
    """Colour the uncoloured nodes of ``nodes(id, color)``; coloured ones stay as they are.

    ``edges`` are distinct half-edges. With ``k_max`` the run fails as soon as
    an uncoloured node has no free colour below it, and with ``max_rounds`` it
    stops there; without them it runs until every node is coloured. On failure
    ``success`` is false, undecided nodes keep a null colour and ``best_k`` is -1.
    ``priority`` is ``id`` or ``hash``: whose proposal wins among neighbours.
    ``stored`` says that ``edges`` is a plain read of files; otherwise it is
    written once first, as it is read more than once.
    """
    spark = nodes.sparkSession
    scratch = Scratch(spark, "coloring")
    none = F.array().cast("array<int>")

    given = scratch.write(
        nodes.select(
            F.col("id").cast("long").alias("id"),
            F.when(is_colored(), F.col("color").cast("int")).alias("color"),
        ),
        "given",
    )
    totals = given.agg(F.count(F.lit(1)).alias("n"), F.count("color").alias("colored")).first()
    todo = given.filter(F.col("color").isNull()).select("id")
    fixed = given.filter(F.col("color").isNotNull())

    reaching = edges.select("src", "dst").filter(F.col("src") != F.col("dst"))
    if not stored:
        reaching = scratch.write(reaching, "edges")
    start = todo
    if totals["colored"]:
        # Only the uncoloured part of the graph matters from here on.
        into = reaching.join(todo.select(F.col("id").alias("dst")), "dst", "left_semi")
        taken = (
            into.join(fixed.select(F.col("id").alias("src"), "color"), "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.collect_set("color").alias("used"))
        )
        own = reaching.join(todo.select(F.col("id").alias("src")), "src", "left_semi")
        reaching = into.join(todo.select(F.col("id").alias("src")), "src", "left_semi")
        start = start.join(taken, "id", "left")
    else:
        own = reaching
        start = start.withColumn("used", none)
    degree = own.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    state, facts = _written(
        scratch,
        start.join(degree, "id", "left").select(
            "id",
            F.coalesce("degree", F.lit(0)).cast("long").alias("degree"),
            F.coalesce("used", none).alias("used"),
            F.lit(None).cast("int").alias("color"),
        ),
        "rounds/round=0",
        k_max,
    )

    live = _Edges(scratch, slot_edges)
    done = 0
    try:
        live.store(reaching, state, facts["degree_sum"], facts["degree_max"])
        last_stored = facts["open_degree"]
        while facts["open"] and not facts["fails"] and (max_rounds is None or done < max_rounds):
            done += 1
            active = state.filter(F.col("color").isNull())
            step = f"rounds/round={done}"
            state, facts = _written(scratch, _round(active, live, priority), step, k_max)
            few = facts["open_degree"] <= COMPACT_SHARE * last_stored
            if live.total > compact_edges and facts["open"] and few:
                open_ids = state.filter(F.col("color").isNull()).select("id")
                left = live.table.select("src", "dst")
                for end in ("src", "dst"):
                    left = left.join(open_ids.withColumnRenamed("id", end), end, "left_semi")
                left = scratch.write(left, f"left{done}")
                remaining = (
                    left.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
                )
                sizes = remaining.agg(F.sum("degree").alias("total"), F.max("degree").alias("top"))
                size = sizes.first()
                live.store(left, remaining, size["total"] or 0, size["top"] or 0)
                last_stored = facts["open_degree"]
    finally:
        live.close()

    success = not facts["open"]
    history = spark.read.schema(STATE + ", round int").parquet(f"{scratch.path}/rounds")
    decided = history.filter(F.col("color").isNotNull()).select("id", "degree", "color", "round")
    undecided = history.filter(F.col("color").isNull() & (F.col("round") == done)).select(
        "id", "degree", "color", F.lit(None).cast("int").alias("round")
    )
    kept = fixed.select("id", F.lit(None).cast("long").alias("degree"), "color", F.lit(0).alias("round"))
    full = decided.unionByName(undecided).unionByName(kept)
    colors = full.select("id", "color")
    top = colors.agg(F.max("color")).first()[0]
    return Coloring(
        colors=colors,
        state=full,
        best_k=(0 if top is None else top + 1) if success else -1,
        success=success,
        rounds=done + (1 if facts["fails"] else 0),
        candidate_fails=facts["fails"],
    )


def _written(
    scratch: Scratch, state: DataFrame, step: str, k_max: int | None
) -> tuple[DataFrame, dict]:
    """The written state of a round, and a few counts taken while it is written."""
    is_open = F.col("color").isNull()
    stuck = F.lit(False) if k_max is None else smallest_free_color("used") >= k_max
    counts = Observation()
    seen = state.observe(
        counts,
        F.count_if(is_open).alias("open"),
        F.count_if(is_open & stuck).alias("fails"),
        F.coalesce(F.sum("degree"), F.lit(0)).alias("degree_sum"),
        F.coalesce(F.max("degree"), F.lit(0)).alias("degree_max"),
        F.coalesce(F.sum(F.when(is_open, F.col("degree"))), F.lit(0)).alias("open_degree"),
    )
    return scratch.write(seen, step), counts.get


def coloring_rounds(coloring: Coloring) -> DataFrame:
    """Per round: uncoloured nodes at its start, messages, ties lost and nodes decided.

    A node sends one message to each neighbour and one to itself while it is
    uncoloured, so everything follows from the round that decided each node.
    The running sums go over one row per round; nodes a failed run left open
    count in all of its rounds.
    """
    per_round = (
        coloring.state.filter(F.col("degree").isNotNull())
        .groupBy("round")
        .agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.col("degree") + 1).alias("sent"))
    )
    from_here = Window.orderBy(F.desc_nulls_first("round"))
    return (
        per_round.withColumn("uncolored", F.sum("nodes").over(from_here))
        .withColumn("messages", F.sum("sent").over(from_here))
        .filter(F.col("round").isNotNull())
        .withColumn("tie_conflicts", F.col("uncolored") - F.col("nodes"))
        .select(
            F.col("round").cast("int").alias("round"),
            "uncolored",
            "messages",
            "tie_conflicts",
            F.col("nodes").alias("decided"),
        )
    )


def color_histogram(colors: DataFrame) -> DataFrame:
    """Nodes per colour."""
    return colors.groupBy("color").agg(F.count(F.lit(1)).alias("node_count"))
