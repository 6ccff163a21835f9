"""Quality of a text: ridge regression on random Fourier features of its statistics.

The features approximate a Gaussian kernel over standardised statistics. The
normal equations are summed per partition, so the driver sees a fixed number of
matrices of fixed size; isotonic regression over score bins turns the ridge
scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import words
from .hashing import unit

FEATURES = 300
LENGTH_SCALE = 2.5  # of the kernel, in standard deviations of a statistic
RIDGE = 1e-3  # per training row
PARTITIONS = 32  # partial sums of the normal equations
BINS = 2000  # of scores, for calibration
CALIBRATION = 0.25  # share of the labelled rows that calibrate
TIE_BREAK = 0.02  # weight of the ridge score in the result, so that level steps stay in order

STATISTICS = (
    "words word_length word_spread longest_word distinct_words repeated_words "
    "upper lower digits stops exclaims bars symbols quotes line_breaks other_bytes "
    "lines distinct_lines line_length bytes"
).split()

_CLASSES = {
    "upper": [range(65, 91)],
    "lower": [range(97, 123)],
    "digits": [range(48, 58)],
    "stops": [b".,;:"],
    "exclaims": [b"!?"],
    "bars": [b"|<>{}[]\\/=_"],
    "symbols": [b"#$%&*@^~+"],
    "quotes": [b"\"'()-`"],
    "line_breaks": [b"\n\r"],
    "other_bytes": [range(128, 256)],
}


def _shares(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    size = np.maximum(np.diff(offsets), 1)
    kind = np.zeros(256, np.int64)
    for number, parts in enumerate(_CLASSES.values(), 1):
        for part in parts:
            kind[list(part)] = number
    owner = np.repeat(np.arange(len(size)), np.diff(offsets))
    width = len(_CLASSES) + 1
    table = np.bincount(owner * width + kind[data], minlength=len(size) * width)
    table = table.reshape(len(size), width)
    return {name: table[:, i + 1] / size for i, name in enumerate(_CLASSES)}


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(owner[new], minlength=n)


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of :data:`STATISTICS` per text; null and empty texts alike."""
    data, offsets = words.text_bytes(column)
    n = len(column)
    out = _shares(data, offsets)
    starts, ends, owner = words.word_spans(data, offsets)
    length = (ends - starts).astype(float)
    count = np.bincount(owner, minlength=n)
    many = np.maximum(count, 1)
    mean = np.bincount(owner, length, minlength=n) / many
    square = np.bincount(owner, length * length, minlength=n) / many
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    hashes = words.word_hashes(data, starts, ends)
    same = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out |= {
        "words": np.log1p(count),
        "word_length": np.log1p(mean),
        "word_spread": np.log1p(np.sqrt(np.maximum(square - mean * mean, 0))),
        "longest_word": np.log1p(longest),
        "distinct_words": _distinct(owner, hashes, n) / many,
        "repeated_words": np.bincount(owner[1:][same], minlength=n) / many,
        "bytes": np.log1p(np.diff(offsets)),
    }
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    finish = np.sort(np.concatenate([breaks, offsets[1:]]))
    # A break at the very end of a text leaves an empty line; empty lines do not count.
    full = finish > begin
    begin, finish = begin[full], finish[full]
    of = np.searchsorted(offsets, begin, side="right") - 1
    lines = np.bincount(of, minlength=n)
    some = np.maximum(lines, 1)
    line_hashes = words.word_hashes(data, begin, finish)
    out |= {
        "lines": np.log1p(lines),
        "distinct_lines": _distinct(of, line_hashes, n) / some,
        "line_length": np.log1p(np.bincount(of, finish - begin, minlength=n) / some),
    }
    return np.stack([out[name] for name in STATISTICS], axis=1)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.slices(batch, "text"):
            rows = text_statistics(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(list(rows), pa.list_(pa.float64()))], ["key", "x"]
            )


def statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, x`` per row: the statistics of the whole text."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _statistics, f"key {kind}, x array<double>"
    )


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps_at: np.ndarray  # ridge scores, ascending
    steps_to: np.ndarray  # calibrated probabilities there

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.ridge(x)
        level = np.interp(raw, self.steps_at, self.steps_to) if len(self.steps_at) else raw
        return np.clip((1 - TIE_BREAK) * level + TIE_BREAK * (raw + 1) / 3, 0, 1)


def _partial_sums(model: Model):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = FEATURES + 1
        left, right = np.zeros((size, size)), np.zeros(size)
        for frame in frames:
            if len(frame):
                phi = model.features(np.stack(frame["x"]))
                left += phi.T @ phi
                right += phi.T @ frame["y"].to_numpy(float)
        yield pd.DataFrame({"matrix": [left.tobytes()], "vector": [right.tobytes()]})

    return run


def _ridge_scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.ridge(x)), batch.column(1)], ["score", "y"]
                )

    return run


def pooled(score: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours: ascending scores and their levels."""
    blocks: list[list[float]] = []  # level, weight, weighted score
    for s, m, w in zip(score, mean, weight, strict=True):
        blocks.append([m, w, s * w])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, s2 = blocks.pop()
            m1, w1, s1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, s1 + s2])
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])


def fit(rows: DataFrame, seed: int = 2) -> Model:
    """Train on all rows of ``key, x, y`` with y 0 or 1; null labels are left out.

    Rows chosen by hash of the key, a quarter, only calibrate. Without rows the
    score is 0.5 everywhere.
    """
    rows = rows.where("y IS NOT NULL").withColumn("held", unit(F.col("key"), seed) < CALIBRATION)
    width = len(STATISTICS)
    moments = rows.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(width)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(width)],
    ).first()
    draw = np.random.default_rng(seed)
    directions = draw.normal(0, 1 / LENGTH_SCALE, (width, FEATURES))
    phases = draw.uniform(0, 2 * np.pi, FEATURES)
    if not moments["n"]:
        none = np.zeros(0)
        half = np.append(np.zeros(FEATURES), 0.5)
        return Model(np.zeros(width), np.ones(width), directions, phases, half, none, none)
    mean = np.array([moments[f"m{i}"] for i in range(width)])
    scale = np.maximum([moments[f"s{i}"] for i in range(width)], 1e-3)
    model = Model(mean, scale, directions, phases, np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))
    some = rows.where("NOT held").select("x", "y").repartition(PARTITIONS)
    left, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
    for row in some.mapInPandas(_partial_sums(model), "matrix binary, vector binary").collect():
        left += np.frombuffer(row["matrix"]).reshape(left.shape)
        right += np.frombuffer(row["vector"])
    penalty = RIDGE * max(left[-1, -1], 1) * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(left + penalty, right)
    held = rows.where("held").select("x", F.col("y").cast("double").alias("y"))
    scored = held.mapInArrow(_ridge_scores(model), "score double, y double")
    bins = (
        scored.groupBy(F.floor((F.col("score") + 1) / 3 * BINS).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.avg("score").alias("score"))
        .orderBy("bin")
        .collect()
    )
    if bins:
        n = np.array([b["n"] for b in bins], float)
        y = np.array([b["y"] for b in bins], float)
        score = np.array([b["score"] for b in bins])
        model.steps_at, model.steps_to = pooled(score, y / n, n)
    return model


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.score(x))], ["key", "score"]
                )

    return run


def score_quality(
    docs: DataFrame,
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """``key, score, predicted`` per row of ``docs``: how likely its label is 1.

    ``labelled`` holds keys and labels of 0 or 1; all its rows that meet a
    document train, by the document's statistics alone. The statistics read the
    whole text and are written once, for training and for scoring. ``predicted``
    is 1 from a score of 0.5.

    Null and empty texts get the score of an empty text, repeated rows the same
    score, and null keys train nothing. Other columns are ignored; an empty table
    gives no rows, and without labels all scores are 0.5.
    """
    table = Scratch(docs.sparkSession, "quality").write(statistics(docs, key, text), "statistics")
    labels = labelled.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
    model = fit(table.join(labels, "key"))
    kind = docs.schema[key].dataType.simpleString()
    scored = table.mapInArrow(_scores(model), f"key {kind}, score double")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select(F.col("key").alias(key), "score", predicted)
