"""Exact top-k by inner product: cover trees over queries and data, searched together."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .vectors import BLOCK, FOUND, Best, block_rows, ranked, stacked, unpack, valid

K = 5
ROWS = 8192  # data rows of a block, each with its own tree
GROUP = 1024  # queries of a group
PIVOTS = 64  # most nodes at the top level of the tree over all rows
SAMPLED = 4096  # rows that the top level is fitted on, as an expected number
LEAF = 256
QUERY_LEAF = 64
SHRINK = 1.3  # covering radius from level to level
MOST_CENTERS = 48


@dataclass
class Node:
    rows: np.ndarray
    center: np.ndarray
    radius: float
    children: list[Node]

    @property
    def reach(self) -> float:
        return float(np.linalg.norm(self.center))


def cover_tree(x: np.ndarray, leaf: int, rows: np.ndarray | None = None, at: int = 0) -> Node:
    """A cover tree: centers are rows, and every row lies within its centers' covering radii.

    A level's centers are chosen greedily, each farther than the level's radius
    from those before. Where rows are so spread that this takes more than
    ``MOST_CENTERS``, all go to the nearest center, whose radius grows to its
    farthest row, so the bounds hold in any case.
    """
    rows = np.arange(len(x)) if rows is None else rows
    center = x[rows[at]]
    distance = np.linalg.norm(x[rows] - center, axis=1)
    radius = float(distance.max(initial=0.0))
    if len(rows) <= leaf or radius == 0:
        return Node(rows, center, radius, [])
    target, nearest, chosen = radius / SHRINK, distance.copy(), [at]
    owner = np.zeros(len(rows), np.int64)
    while nearest.max() > target and len(chosen) < MOST_CENTERS:
        far = int(nearest.argmax())
        away = np.linalg.norm(x[rows] - x[rows[far]], axis=1)
        closer = away < nearest
        nearest[closer] = away[closer]
        owner[closer] = len(chosen)
        chosen.append(far)
    children = []
    for number, row in enumerate(chosen):
        own = np.flatnonzero(owner == number)
        if len(own) == len(rows):
            return Node(rows, center, radius, [])
        children.append(cover_tree(x, leaf, rows[own], int(np.flatnonzero(own == row)[0])))
    return Node(rows, center, radius, children)


def bound(q: Node, p: Node) -> float:
    """No pair of the two nodes has a larger inner product."""
    product = float(q.center @ p.center)
    slack = q.reach * p.radius + p.reach * q.radius + q.radius * p.radius
    return product + slack + 1e-9 * (abs(product) + slack + 1)


def dual_search(
    queries: np.ndarray, q_tree: Node, ids: np.ndarray, x: np.ndarray, tree: Node, best: Best
) -> None:
    """Offer every pair that can matter to ``best``, the most promising nodes first."""
    stack = [(bound(q_tree, tree), q_tree, tree)]
    while stack:
        limit, q, p = stack.pop()
        if limit < best.worst[q.rows].min():
            continue
        if not q.children and not p.children:
            best.offer(q.rows, ids[p.rows], queries[q.rows] @ x[p.rows].T)
            continue
        if p.children and (not q.children or p.radius >= q.radius):
            pairs = [(q, child) for child in p.children]
        else:
            pairs = [(child, p) for child in q.children]
        stack += sorted(((bound(a, b), a, b) for a, b in pairs), key=lambda row: row[0])


def _pivots(rows: DataFrame, pivots: int, per: int, sampled: int) -> dict[int, np.ndarray]:
    """Far-apart rows of a bounded sample, one for ``per`` rows, per number of components."""
    counts = {r["size"]: r["count"] for r in rows.groupBy(F.size("v").alias("size")).count().collect()}
    total = max(sum(counts.values()), 1)
    u = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
    sample = rows.where(u < sampled / total).orderBy("id").collect()
    out = {}
    for size in counts:
        x = np.array([r["v"] for r in sample if len(r["v"]) == size]).reshape(-1, size)
        chosen, nearest = [0], np.full(len(x), np.inf)
        for _ in range(min(pivots, len(x), -(-counts[size] // per)) - 1):
            nearest = np.minimum(nearest, np.linalg.norm(x - x[chosen[-1]], axis=1))
            if nearest.max() == 0:
                break
            chosen.append(int(nearest.argmax()))
        out[size] = x[chosen] if len(x) else np.zeros((1, size))
    return out


def _parts(pivots: dict[int, np.ndarray]):
    """Rows with their number of components and nearest pivot as ``part``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, rows in frame.groupby(frame["v"].map(len)):
                x, centers = stacked(rows), pivots[size]
                far = (centers * centers).sum(axis=1) - 2 * x @ centers.T
                yield rows.assign(part=size * 4096 + far.argmin(axis=1))

    return run


def _searched(k: int):
    """Best candidates of each pair of a query group and a data block, flushed per group."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: dict[bytes, tuple] = {}
        for frame in frames:
            for row in frame.itertuples(index=False):
                q_ids, q = unpack(row.q_ids, row.q_matrix)
                ids, x = unpack(row.ids, row.matrix)
                key = (row.block,)
                if key not in trees:
                    trees.clear()
                    trees[key] = cover_tree(x, LEAF)
                best = Best(q_ids, k)
                if row.worst is not None:
                    best.worst = np.frombuffer(row.worst, np.float64).copy()
                dual_search(q, cover_tree(q, QUERY_LEAF), ids, x, trees[key], best)
                yield best.frame()

    return run


def top_k(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    transform: Callable[[Column], Column] | None = None,
    rows: int = ROWS,
    group: int = GROUP,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query, exactly.

    Queries are the rows whose id meets ``is_query``, candidates all rows but
    those with the query's id; ties go to the smaller id, and a query with fewer
    candidates gets all. ``transform`` changes components first. Scores are sums
    of doubles: exact for whole components as long as they stay below 2**53.

    Rows are dealt to the nearest of a few far-apart pivots and cut into blocks;
    every group of queries meets every block once, each side in a cover tree, and
    node pairs fall away once their bound is below the worst k-th score of the
    group. Each group meets its own pivot's blocks first, and takes its worst
    scores from there to the rest.

    Null vectors and ids, and vectors with null or non-finite components, take no
    part; vectors of different lengths do not meet. Rows that repeat id and
    vector count once. Other columns are ignored; an empty table, or one without
    queries, gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "top_k")
    data = valid(vectors, id_col, vector_col)
    if transform is not None:
        data = data.withColumn("v", F.transform("v", transform))
    data = scratch.write(data, "rows")
    parts = data.mapInPandas(
        _parts(_pivots(data, PIVOTS, rows, SAMPLED)), "id long, v array<double>, part long"
    )
    parts = scratch.write(parts, "parts")
    # Rows of a part are dealt to as many tasks as it has blocks.
    counts = parts.groupBy("part").agg(F.ceil(F.count("*") / rows).alias("blocks"))
    dealt = parts.join(counts, "part").withColumn("deal", F.pmod(F.xxhash64("id"), "blocks"))
    blocks = (
        dealt.repartition("part", "deal").sortWithinPartitions("part", "deal").select("id", "v", "part")
        .mapInPandas(block_rows(rows), BLOCK)
        .withColumn("block", F.monotonically_increasing_id())
    )
    blocks = scratch.write(blocks, "blocks")
    queries = (
        parts.where(is_query(F.col("id")))
        .repartition("part").sortWithinPartitions("part", "id")
        .mapInPandas(block_rows(group), BLOCK)
        .select(
            F.col("part").alias("q_part"), F.col("ids").alias("q_ids"),
            F.col("matrix").alias("q_matrix"), F.monotonically_increasing_id().alias("q_group"),
        )
    )
    queries = scratch.write(queries, "queries")
    own = queries.join(blocks, F.col("q_part") == F.col("part"))
    own = own.withColumn("worst", F.lit(None).cast("binary"))
    near = scratch.write(_search(own, k), "near")
    worst = _worst(queries, near, k, scratch)
    # A group meets each block of its number of components, by the block's number.
    listed = blocks.groupBy(F.floor(F.col("part") / 4096).alias("size")).agg(
        F.collect_list(F.struct("block", "part")).alias("others")
    )
    sized = queries.join(worst, "q_group").withColumn("size", F.floor(F.col("q_part") / 4096))
    pairs = (
        sized.join(listed, "size").withColumn("other", F.explode("others")).drop("others")
        .where("other.part <> q_part").withColumn("block", F.col("other.block")).drop("other")
    )
    rest = pairs.join(blocks, "block")
    return ranked(near.union(_search(rest, k)), k)


def _search(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.select("block", "q_ids", "q_matrix", "ids", "matrix", "worst").mapInPandas(
        _searched(k), FOUND
    )


def _worst(queries: DataFrame, near: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """The k-th score so far of each query of a group, as one value per group."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(frame["q_ids"].iloc[0], np.int64)
        found = frame.groupby("query_id")["score"].agg(list).to_dict()
        worst = [sorted(found.get(i, []))[::-1][k - 1 : k] or [-np.inf] for i in ids.tolist()]
        return pd.DataFrame(
            {"q_group": frame["q_group"].iloc[:1], "worst": [np.array(worst, float).tobytes()]}
        )

    members = queries.select("q_group", "q_ids")
    kept = ranked(near, k)

    def ids_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids = np.frombuffer(row.q_ids, np.int64)
                yield pd.DataFrame({"q_group": row.q_group, "query_id": ids})

    of_query = members.mapInPandas(ids_of, "q_group long, query_id long")
    scores = of_query.join(kept.select("query_id", "score"), "query_id")
    out = members.join(scores, "q_group", "left").groupBy("q_group").applyInPandas(
        run, "q_group long, worst binary"
    )
    return scratch.write(out, "worst")
