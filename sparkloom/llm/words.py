"""Words, shingles and bounded batches of whole texts, vectorised over UTF-8 bytes.

A word is a run of bytes other than the six ASCII blanks (space, tab to
carriage return). Hashes are 64 bits wide: a table value per byte times a power
of an odd base, summed over a word by prefix sums and moved to the word's start
by the inverse power, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 2 << 20  # text bytes handled at once in a task; a longer text goes alone

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on all of ``x``."""
    with np.errstate(over="ignore"):
        x = x + _U((seed * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_VALUE = mix(np.arange(256, dtype=_U), 7)


class _Powers:
    """Powers of an odd base modulo 2**64, kept up to the longest input so far."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, dtype=_U)

    def upto(self, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            while len(self.values) < n:
                step = _U(pow(self.base, len(self.values), 1 << 64))
                self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


_POWER, _BACK = _Powers(_BASE), _Powers(_INVERSE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def releasing(run):
    """``run`` over a task's batches, handing Arrow's unused memory back when they end.

    Python workers outlive their tasks; without this they keep the largest
    batches' memory while later stages run beside them.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return wrapped


def slices(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` text bytes, or one row."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def word_spans(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order; words end with their text."""
    wordy = ~blank[data]
    first = wordy.copy()
    first[1:] &= ~wordy[:-1]
    last = wordy.copy()
    last[:-1] &= ~wordy[1:]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    first[bounds] |= wordy[bounds]
    last[bounds - 1] |= wordy[bounds - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word, with A-Z taken as a-z."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(_VALUE[_LOWER[data]] * _POWER.upto(len(data)), out=sums[1:])
        moved = (sums[ends] - sums[starts]) * _BACK.upto(len(data) + 1)[starts]
        return mix(moved + (ends - starts).astype(_U))


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text: sorted hashes and offsets per text.

    A text with fewer than ``k`` words has one shingle, all its words; a text
    without words has none.
    """
    data, offsets = text_bytes(column)
    starts, ends, owner = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n_words = np.bincount(owner, minlength=len(column))
    with np.errstate(over="ignore"):
        whole = np.zeros(max(len(hashes) - k + 1, 0), dtype=_U)
        for i in range(k):
            whole = mix(whole * _U(3) + hashes[i : i + len(whole)], i + 1)
        inside = owner[: len(whole)] == owner[k - 1 : k - 1 + len(whole)]
        values, owners = whole[inside], owner[: len(whole)][inside]
        short = np.flatnonzero((n_words > 0) & (n_words < k))
        if len(short):
            at = np.concatenate([[0], np.cumsum(n_words)])
            some = np.zeros(len(short), dtype=_U)
            for i in range(k - 1):
                there = n_words[short] > i
                some[there] = mix(some[there] * _U(3) + hashes[at[short[there]] + i], i + 1)
            values = np.concatenate([values, mix(some, 99)])
            owners = np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(len(column) + 1))
