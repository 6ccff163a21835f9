"""Vectors as matrices: valid rows, and bounded blocks of rows that travel as one value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the rows that take part, once each: no nulls, all components finite."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), finite.alias("ok"))
    rows = rows.where("id IS NOT NULL AND ok AND size(v) > 0").select("id", "v")
    return rows.dropDuplicates(["id", "v"])


def stacked(frame: pd.DataFrame, column: str = "v") -> np.ndarray:
    return np.stack(frame[column]).astype(np.float64)


def block_rows(size: int):
    """Runs of at most ``size`` rows of one ``part`` as single rows of ids and matrix.

    Rows arrive sorted by ``part``; a run that a batch cuts gives two rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, rows in frame.groupby("part", sort=False):
                for start in range(0, len(rows), size):
                    some = rows.iloc[start : start + size]
                    yield pd.DataFrame(
                        {
                            "part": [part],
                            "n": [len(some)],
                            "ids": [some["id"].to_numpy(np.int64).tobytes()],
                            "matrix": [stacked(some).tobytes()],
                        }
                    )

    return run


BLOCK = "part long, n int, ids binary, matrix binary"


def unpack(ids: bytes, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(matrix, np.float64).reshape(len(ids), -1)


class Best:
    """The k best of all offered scores per query: largest first, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.worst = np.full(len(queries), -np.inf)
        self.ids = [np.zeros(0, np.int64)] * len(queries)
        self.scores = [np.zeros(0)] * len(queries)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of queries ``rows`` (down) with candidates ``ids`` (across)."""
        scores = np.where(self.queries[rows, None] == ids[None, :], -np.inf, scores)
        if scores.shape[1] > self.k:
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
            floor = np.maximum(kth, self.worst[rows])
        else:
            floor = self.worst[rows]
        good = (scores >= floor[:, None]) & (scores > -np.inf)
        for i in np.flatnonzero(good.any(axis=1)):
            row, at = rows[i], np.flatnonzero(good[i])
            all_ids = np.concatenate([self.ids[row], ids[at]])
            all_scores = np.concatenate([self.scores[row], scores[i, at]])
            order = np.lexsort((all_ids, -all_scores))[: self.k]
            self.ids[row], self.scores[row] = all_ids[order], all_scores[order]
            if len(order) == self.k:
                self.worst[row] = self.scores[row][-1]

    def frame(self) -> pd.DataFrame:
        counts = [len(x) for x in self.ids]
        return pd.DataFrame(
            {
                "query_id": np.repeat(self.queries, counts),
                "vec_id": np.concatenate([np.zeros(0, np.int64), *self.ids]),
                "score": np.concatenate([np.zeros(0), *self.scores]),
            }
        )


FOUND = "query_id long, vec_id long, score double"


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best of the parts' results."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    rows = found.dropDuplicates(["query_id", "vec_id", "score"])
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows.where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
