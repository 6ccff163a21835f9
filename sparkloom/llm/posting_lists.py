"""Approximate nearest neighbours by balanced posting lists around centroids.

Centroids are fitted on a bounded sample and sent to all tasks together with a
neighbour graph over them. A vector is listed under its nearest centroid and
under others almost as near; a query reads the lists whose centroids lie within
a ratio of the nearest distance, found by walking the graph.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .vectors import FOUND, Best, ranked, stacked, valid
from .words import releasing

K = 20
SAMPLED = 16_384  # rows that centroids, graph and ratio are fitted on, as an expected number
LIST = 1024  # wished rows of a list before replication
CENTROIDS = 4096  # most lists
ROUNDS = 12  # of balanced k-means
COPIES = 3  # lists of a vector at most
BOUNDARY = 1.05  # distance ratio up to which a vector is listed again
WANTED = 0.96  # share of the true neighbours that the ratio is fitted to find, on the sample
TRIALS = 256  # sample queries for that
LINKS = 16  # neighbours of a centroid in the graph
ENTRIES = 16  # start of a walk, of either kind
ROWS = 16_384  # rows of a block of a list, as an expected number
HELD = 1 << 20  # components of the queries that meet a block at once, as an expected number
FLUSH = 20_000  # queries whose best a task keeps at once
DISTANCES = 1 << 22  # distances from vectors to centroids that a task holds at once
SCORES = 1 << 20  # scores that a task holds at once
VALUES = 1 << 20  # components of the listed vectors that a task hands over at once


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    # One array of all distances, worked on in place.
    square = 2 * x @ centers.T
    np.subtract((x * x).sum(axis=1)[:, None], square, out=square)
    square += (centers * centers).sum(axis=1)
    return np.sqrt(np.maximum(square, 0, out=square), out=square)


def balanced_centers(x: np.ndarray, lists: int, draw: np.random.Generator) -> np.ndarray:
    """k-means whose large clusters push rows away: distances grow with a cluster's surplus."""
    centers = x[draw.choice(len(x), lists, replace=False)]
    surplus = np.zeros(lists)
    for _ in range(ROUNDS):
        distance = _distances(x, centers)
        distance += surplus
        owner = distance.argmin(axis=1)
        counts = np.bincount(owner, minlength=lists)
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, x)
        full = counts > 0
        centers[full] = sums[full] / counts[full, None]
        spread = np.linalg.norm(x - centers[owner], axis=1).mean()
        surplus += 0.05 * spread * (counts * lists / len(x) - 1)
        surplus -= surplus.min()
    return centers


@dataclass
class Index:
    """Centroids in the space in which the largest inner product is the least distance."""

    centers: np.ndarray
    links: list[np.ndarray]  # neighbours of each centroid, either way
    entries: np.ndarray  # where walks start
    longest: float  # norm of the longest vector
    ratio: float
    held: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # ids of each list

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Data vectors with a component that gives all the same norm."""
        square = np.maximum(self.longest**2 - (x * x).sum(axis=1), 0)
        return np.hstack([x, np.sqrt(square)[:, None]])

    def aimed(self, q: np.ndarray) -> np.ndarray:
        """Query vectors scaled to the norm of the data, which changes no order."""
        norm = np.linalg.norm(q, axis=1, keepdims=True)
        return np.hstack([q * (self.longest / norm), np.zeros((len(q), 1))])

    def lists_of(self, x: np.ndarray) -> list[np.ndarray]:
        """Lists of each data vector: the nearest, and the next ones within the boundary ratio."""
        found: list[np.ndarray] = []
        step = max(1, DISTANCES // len(self.centers))
        for start in range(0, len(x), step):
            distance = _distances(self.lifted(x[start : start + step]), self.centers)
            near = np.argsort(distance, axis=1)[:, :COPIES]
            rows = np.take_along_axis(distance, near, axis=1)
            inside = rows <= BOUNDARY * rows[:, :1]
            found += [n[i] for n, i in zip(near, inside, strict=True)]
        return found

    def read_by(self, q: np.ndarray, k: int) -> list[np.ndarray]:
        """Lists that each query reads, by walking the graph of centroids from near to far.

        Where those may hold fewer than ``k`` other rows, the next nearest ones
        follow until they do, or until there are no more.
        """
        return [self._enough(row, self._walk(row), k) for row in self.aimed(q)]

    def _enough(self, q: np.ndarray, lists: np.ndarray, k: int) -> np.ndarray:
        # The query's own id may be in each list.
        others = np.maximum(self.held - 1, 0)
        if others[lists].sum() >= k:
            return lists
        near = np.argsort(np.linalg.norm(self.centers - q, axis=1), kind="stable")
        near = near[~np.isin(near, lists) & (self.held[near] > 0)]
        more = others[lists].sum() + np.cumsum(others[near])
        return np.concatenate([lists, near[: np.searchsorted(more, k) + 1]])

    def _walk(self, q: np.ndarray) -> np.ndarray:
        def away(rows: np.ndarray) -> np.ndarray:
            return np.linalg.norm(self.centers[rows] - q, axis=1)

        seen = set(self.entries.tolist())
        heap = list(zip(away(self.entries).tolist(), self.entries.tolist(), strict=True))
        heapq.heapify(heap)
        found: list[tuple[float, int]] = []
        nearest, idle = np.inf, 0
        while heap:
            distance, row = heapq.heappop(heap)
            found.append((distance, row))
            if distance < nearest:
                nearest, idle = distance, 0
            # Beyond the ratio, a few more steps look for a way back to nearer centroids.
            idle = idle + 1 if distance > self.ratio * nearest else 0
            if idle > 2 * LINKS:
                break
            new = np.array([r for r in self.links[row].tolist() if r not in seen], np.int64)
            if len(new):
                seen.update(new.tolist())
                for pair in zip(away(new).tolist(), new.tolist(), strict=True):
                    heapq.heappush(heap, pair)
        return np.array([r for d, r in found if d <= self.ratio * nearest], np.int64)


def _graph(centers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Each centroid's nearest ones, linked both ways, and entries for walks.

    Entries are spread over the numbers, and centroids that are nobody's near
    neighbour are entries as well, the loneliest first.
    """
    n = len(centers)
    near = np.argsort(_distances(centers, centers), axis=1)[:, 1 : LINKS + 1]
    ends = np.stack([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    ends = np.unique(np.hstack([ends, ends[::-1]]), axis=1)
    links = np.split(ends[1], np.searchsorted(ends[0], np.arange(1, n)))
    chosen_by = np.bincount(near.ravel(), minlength=n)
    spread = np.linspace(0, n - 1, ENTRIES).astype(np.int64)
    return links, np.unique(np.concatenate([spread, np.argsort(chosen_by, kind="stable")[:ENTRIES]]))


def build_index(x: np.ndarray, total: int, longest: float, k: int = K, seed: int = 9) -> Index:
    """Fit centroids, graph and ratio on the sample ``x`` of ``total`` rows."""
    draw = np.random.default_rng(seed)
    index = Index(np.zeros((1, x.shape[1] + 1)), [], np.zeros(1, np.int64), longest, np.inf)
    lifted = index.lifted(x)
    lists = int(max(1, min(-(-total // LIST), CENTROIDS, len(x) // 8)))
    index.centers = balanced_centers(lifted, lists, draw)
    index.links, index.entries = _graph(index.centers)
    # The least ratio at which the lists read hold the wanted share of true neighbours.
    trial = draw.choice(len(x), min(TRIALS, len(x)), replace=False)
    scores = x[trial] @ x.T
    scores[np.arange(len(trial)), trial] = -np.inf
    true = np.argsort(-scores, axis=1)[:, :k]
    owners = index.lists_of(x)
    distance = _distances(index.aimed(x[trial]), index.centers)
    needed = [
        distance[i, owners[j]].min() / max(distance[i].min(), 1e-12)
        for i in range(len(trial))
        for j in true[i]
    ]
    index.ratio = float(np.quantile(needed, WANTED)) if needed else np.inf
    return index


def _postings(index: dict[int, Index], k: int | None = None):
    """Rows of id, vector and ``part``, the number of a list, once per list of the vector.

    With ``k``, the rows are queries and the lists those they read; ``first``
    marks the nearest list of a row of data. The rows come in pieces of at most
    ``VALUES`` components, as a query may read hundreds of lists.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, rows in frame.groupby(frame["v"].map(len)):
                x = stacked(rows)
                lists = index[size].read_by(x, k) if k else index[size].lists_of(x)
                copies = np.repeat(np.arange(len(rows)), [len(n) for n in lists])
                part = size * CENTROIDS + np.concatenate(lists)
                first = np.concatenate([np.arange(len(n)) == 0 for n in lists])
                step = max(1, VALUES // size)
                for start in range(0, len(copies), step):
                    some = slice(start, start + step)
                    yield rows.iloc[copies[some]].assign(part=part[some], first=first[some])

    return run


def _searched(k: int):
    """Best candidates per query over the tiles of a task.

    A tile is the rows of one part, block and deal, its queries first. Those are
    held while its candidates pass by; scores of at most ``SCORES`` pairs, or one
    query, are held at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pd.DataFrame] = []
        tile, asked, best, q = None, [], None, None

        def merged() -> pd.DataFrame:
            rows = pd.concat(kept).drop_duplicates(["query_id", "vec_id", "score"])
            rows = rows.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            return rows.groupby("query_id").head(k)

        def given(rows: pd.DataFrame) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(rows, preserve_index=False)

        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("part", "block", "deal", "candidate")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, stop in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                rows = batch.slice(start, stop - start)
                if rows.num_rows == 0:
                    continue
                if tile != (key := tuple(keys[:3, start].tolist())):
                    if best is not None:
                        kept.append(best.frame())
                    tile, asked, best = key, [], None
                    if sum(map(len, kept)) > FLUSH * k:
                        kept[:] = [merged()]
                        if len(kept[0]) > FLUSH * k // 2:
                            yield given(kept.pop())
                ids = rows["id"].to_numpy()
                x = rows["v"].flatten().to_numpy().reshape(len(ids), -1)
                if not keys[3, start]:
                    asked.append((ids, x))
                    continue
                if best is None:
                    if not asked:
                        continue
                    best = Best(np.concatenate([i for i, _ in asked]), k)
                    q = np.concatenate([v for _, v in asked])
                step = max(1, SCORES // len(ids))
                for at in range(0, len(q), step):
                    some = np.arange(at, min(at + step, len(q)))
                    best.offer(some, ids, np.einsum("ij,kj->ik", q[some], x))
        if best is not None:
            kept.append(best.frame())
        if kept:
            yield given(merged())

    return run


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: nearest found by inner product, largest first.

    Queries are the rows whose id meets ``is_query``, candidates all rows but
    those with the query's id; ties go to the smaller id. Every row is listed;
    centroids, graph and ratio come from a sample of about ``SAMPLED`` rows. Long
    lists and many queries are cut into blocks and deals that meet one by one.
    Scores are those of the vectors as given, in doubles.

    A query goes on to further lists until they hold ``k`` candidates; it finds
    fewer only if there are no more.
    Null vectors and ids, zero vectors, and vectors with null or non-finite
    components take no part; vectors of different lengths do not meet. Rows that
    repeat id and vector count once. Other columns are ignored; an empty table,
    or one without queries, gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "nearest")
    data = valid(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    data = scratch.write(data, "rows")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = data.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("n"),
        F.max(norm).alias("longest"),
        F.count_if(is_query(F.col("id"))).alias("asked"),
    )
    facts = {r["size"]: r for r in facts.collect()}
    total = max(sum(r["n"] for r in facts.values()), 1)
    u = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = data.where(u < SAMPLED / total).orderBy("id").collect()
    index = {}
    for size, r in facts.items():
        x = [c["v"] for c in chosen if len(c["v"]) == size] or [[r["longest"]] + [0.0] * (size - 1)]
        index[size] = build_index(np.array(x), r["n"], r["longest"], k)

    schema = "id long, v array<double>, part long, first boolean"
    listed = data.mapInPandas(_postings(index), schema)
    listed = scratch.write(listed, "listed")
    # One row per list; a row counts under its nearest list only, so no candidate counts twice.
    sizes = listed.where("first").select("part", "id").distinct().groupBy("part").count().collect()
    for size in index:
        index[size].held = np.zeros(len(index[size].centers), np.int64)
    for r in sizes:
        index[r["part"] // CENTROIDS].held[r["part"] % CENTROIDS] = r["count"]
    # Blocks of a list's rows meet deals of its queries; one row per list.
    counts = listed.groupBy("part").count().collect()
    tiles = F.broadcast(
        vectors.sparkSession.createDataFrame(
            [
                (r["part"], -(-r["count"] // ROWS), max(1, -(-facts[size]["asked"] * size // HELD)))
                for r in counts
                for size in [r["part"] // CENTROIDS]
            ],
            "part long, blocks int, deals int",
        )
    )
    spread = F.xxhash64("id", "v")
    rows = listed.join(tiles, "part").select(
        "part",
        F.pmod(spread, "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"),
        F.lit(1).alias("candidate"),
        "id",
        "v",
    )
    read = data.where(is_query(F.col("id"))).mapInPandas(_postings(index, k), schema)
    asked = read.join(tiles, "part").select(
        "part",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(spread, "deals").cast("int").alias("deal"),
        F.lit(0).alias("candidate"),
        "id",
        "v",
    )
    # A deal's tiles follow each other, so that a task merges what its queries found.
    dealt = asked.unionByName(rows).repartition("part", "block", "deal")
    dealt = dealt.sortWithinPartitions("deal", "part", "block", "candidate")
    found = dealt.mapInArrow(releasing(_searched(k)), FOUND)
    return ranked(found, k)
