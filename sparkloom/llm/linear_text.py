"""Language of a text: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import words
from .hashing import unit

UNKNOWN = "und"
BUCKETS = 1 << 14
WIDTH = 16  # of an embedding
PER_LABEL = 500  # labelled texts per label that training takes, as an expected number
EPOCHS = 6
BATCH = 32
RATE = 0.1
FRAGMENT = 60  # characters of the short training copy of each text
CALIBRATION = 0.2  # share of the training texts that set temperature and rejection
REJECTED = 0.002  # share of rightly recognised calibration texts that may be rejected
MARGIN = 0.1  # above even chances, the most that acceptance ever asks for
POSITIONS = 1 << 18  # characters handled at once


_LOWER: list[np.ndarray] = []


def _lower() -> np.ndarray:
    """Lower case per code point, 0 for all but letters; made once per process."""
    if _LOWER:
        return _LOWER[0]
    letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x1E944):
        x = chr(i).lower() if letters[i] else ""
        if len(x) == 1:
            lower[i] = ord(x)
    lower[~letters] = 0
    _LOWER.append(lower)
    return lower


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, 0 for the rest and between texts; start of each text."""
    lower = _lower()
    parts = [np.frombuffer((x or "").encode("utf-32-le", "replace"), np.uint32) for x in texts]
    starts = np.cumsum([0] + [len(x) + 1 for x in parts])
    codes = np.zeros(starts[-1] + 1, np.uint32)
    for x, start in zip(parts, starts[:-1], strict=True):
        codes[start + 1 : start + 1 + len(x)] = lower[x]
    return codes, starts


def _subwords(codes: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Position and bucket of every subword of one to four signs, word edges included."""
    word = codes != 0
    value = codes.astype(np.uint64)
    hashed = value.copy()
    inner = None
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    with np.errstate(over="ignore"):
        for n in range(1, 5):
            size = len(codes) - n + 1
            if size <= 0:
                return
            if n == 1:
                valid = word
            else:
                hashed = hashed[:size] * np.uint64(0x100000001B3) + value[n - 1 :]
                if n == 2:
                    valid = word[:size] | word[1:]
                else:
                    inner = word[1 : 1 + size] if n == 3 else inner[:size] & word[2 : 2 + size]
                    valid = inner
            at = np.flatnonzero(valid[:size])
            mixed = (hashed[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield at, (mixed >> shift).astype(np.int64)


@dataclass
class Model:
    """Scores per bucket (embedding times softmax weights) and what calibration found."""

    labels: list[str]
    scores: np.ndarray  # buckets x labels
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logits per text, and whether it has a letter."""
        codes, starts = _codes(texts)
        sums = np.zeros((len(texts), len(self.labels)))
        counts = np.zeros(len(texts), np.int64)
        for low in range(0, len(codes), POSITIONS):
            # A piece sees the three signs after it, so no subword is lost at its end.
            piece = codes[low : low + POSITIONS + 3]
            for at, bucket in _subwords(piece, len(self.scores)):
                inside = at < POSITIONS
                at, bucket = at[inside], bucket[inside]
                owner = np.searchsorted(starts, at + low, side="right") - 1
                owner = np.minimum(owner, len(texts) - 1)
                counts += np.bincount(owner, minlength=len(texts))
                for label in range(len(self.labels)):
                    sums[:, label] += np.bincount(
                        owner, self.scores[bucket, label], minlength=len(texts)
                    )
        logits = sums / np.maximum(counts, 1)[:, None]
        return logits / self.temperature, counts > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Label, probability and acceptance per text."""
        logits, known = self.logits(texts)
        if not self.labels:
            known[:] = False
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), known
        chance = _softmax(logits)
        best = chance.argmax(axis=1)
        score = np.where(known, chance.max(axis=1), 0.0)
        labels = [self.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return labels, score, known & (score >= self.threshold)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _features(buckets: int):
    """Shares of the buckets in each text and in a fragment from its middle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, label, text in zip(frame["key"], frame["label"], frame["text"], strict=True):
                middle = len(text) // 2
                for short, part in ((0, text), (1, text[middle : middle + FRAGMENT])):
                    codes, _ = _codes([part])
                    counts = np.zeros(buckets, np.int64)
                    for _, bucket in _subwords(codes, buckets):
                        counts += np.bincount(bucket, minlength=buckets)
                    at = np.flatnonzero(counts)
                    if len(at):
                        share = (counts[at] / counts[at].sum()).astype(np.float32)
                        yield pd.DataFrame(
                            {
                                "key": [key],
                                "label": [label],
                                "short": [short],
                                "bucket": [at.astype(np.int32).tobytes()],
                                "share": [share.tobytes()],
                            }
                        )

    return run


def _sample(docs: DataFrame, per_label: int, seed: int) -> DataFrame:
    """Labelled texts, about ``per_label`` of each label, chosen by hash of the key.

    The counts are written first, so that Spark knows their size and moves no texts.
    """
    counts = Scratch(docs.sparkSession, "labels").write(docs.groupBy("label").count(), "counts")
    chance = counts.select(
        F.col("label").alias("of"), (F.lit(float(per_label)) / F.col("count")).alias("chance")
    )
    return (
        docs.withColumn("u", unit(F.col("key"), seed))
        .join(chance, F.col("label") == F.col("of"))
        .where("u < chance")
        .select("key", "label", "text")
    )


def _descend(rows: list, labels: list[str], buckets: int, seed: int) -> Model:
    """Stochastic gradient descent with a step per weight that shrinks as it is used."""
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.1, (buckets, WIDTH)).astype(np.float32)
    weights = draw.normal(0, 0.5, (WIDTH, len(labels))).astype(np.float32)
    used = [np.full_like(x, 1e-6) for x in (table, weights)]
    target = np.array([labels.index(r["label"]) for r in rows])
    seen = np.zeros(buckets, bool)
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            x = np.zeros((len(chosen), buckets), np.float32)
            for i, r in enumerate(chosen):
                at = np.frombuffer(rows[r]["bucket"], np.int32)
                x[i, at] = np.frombuffer(rows[r]["share"], np.float32)
                seen[at] = True
            hidden = x @ table
            error = _softmax(hidden @ weights)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error /= len(chosen)
            steps = (x.T @ (error @ weights.T), hidden.T @ error)
            for value, step, total in zip((table, weights), steps, used, strict=True):
                total += step * step
                value -= RATE * step / np.sqrt(total)
    # Subwords that training never saw say nothing: a text of them has even chances.
    table[~seen] = 0
    return Model(labels, (table @ weights).astype(np.float64))


def _calibrate(model: Model, rows: list) -> None:
    """Temperature of least loss over held-back rows, and the threshold of rejection."""
    if not rows:
        return
    logits = np.array(
        [
            np.frombuffer(r["share"], np.float32) @ model.scores[np.frombuffer(r["bucket"], np.int32)]
            for r in rows
        ]
    )
    target = np.array([model.labels.index(r["label"]) for r in rows])
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(rows)), target] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    chance = _softmax(logits / model.temperature)
    right = chance.max(axis=1)[chance.argmax(axis=1) == target]
    if len(right) and len(model.labels) > 1:
        model.threshold = float(min(np.quantile(right, REJECTED), 1 / len(model.labels) + MARGIN))


def train(
    docs: DataFrame,
    key: str,
    text: str,
    label: str,
    per_label: int = PER_LABEL,
    buckets: int = BUCKETS,
    seed: int = 6,
) -> Model:
    """Fit on a bounded sample of the labelled texts, about ``per_label`` per label.

    Rows without text or label, and texts without letters, teach nothing. Every
    label is learned, however many there are; the model has a number per bucket
    and label. What reaches the driver is at most two rows of bucket shares per
    sampled text, however long. The result depends on the rows, not on their order.
    """
    known = docs.select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).alias("text")
    ).where("label IS NOT NULL AND text IS NOT NULL")
    kind = known.schema["key"].dataType.simpleString()
    rows = (
        _sample(known, per_label, seed)
        .mapInPandas(
            _features(buckets), f"key {kind}, label string, short int, bucket binary, share binary"
        )
        .withColumn("held", unit(F.col("key"), seed + 1) < CALIBRATION)
        .collect()
    )
    rows.sort(key=lambda r: (r["label"], r["key"] is None, r["key"], r["short"], r["share"]))
    labels = sorted({r["label"] for r in rows})
    fit = [r for r in rows if not r["held"]] or rows
    if not labels:
        return Model([], np.zeros((buckets, 0)))
    model = _descend(fit, labels, buckets, seed)
    _calibrate(model, [r for r in rows if r["held"] and not r["short"]])
    return model


def _predictions(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                texts, size = [], 0
                while start + len(texts) < batch.num_rows and size < POSITIONS:
                    texts.append(batch.column(1)[start + len(texts)].as_py())
                    size += len(texts[-1] or "") + 1
                label, score, accepted = model.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array(label, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(accepted, pa.bool_()),
                    ],
                    ["key", "lang_pred", "score", "accepted"],
                )
                start += len(texts)

    return run


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, accepted`` for every row, from its whole text.

    ``lang_pred`` is the likeliest learned label, or ``und`` with score 0 if the
    text is null or has no letter, or if nothing was learned. ``accepted`` is
    false for those, and for texts whose calibrated probability is below the
    model's threshold. Repeated rows are kept and predicted alike; null keys stay
    null, other columns are ignored, and an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(
            words.releasing(_predictions(model)), f"key {kind}, lang_pred string, score double, accepted boolean"
        )
        .withColumnRenamed("key", key)
    )


def keep_accepted(docs: DataFrame, model: Model, text: str = "text", label: str = "lang") -> DataFrame:
    """The rows whose text :func:`predict` accepts, with all columns; null labels are filled in."""
    label_at, text_at = docs.columns.index(label), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text):
                found = [r.columns[1:] for r in _predictions(model)([_pair(part.column(text_at))])]
                guess = pa.concat_arrays([r[0] for r in found])
                accepted = pa.concat_arrays([r[2] for r in found])
                columns = list(part.columns)
                columns[label_at] = pa.compute.coalesce(columns[label_at], guess)
                yield pa.RecordBatch.from_arrays(columns, part.schema.names).filter(accepted)

    return docs.mapInArrow(words.releasing(run), docs.schema)


def _pair(texts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], ["key", "text"])
