"""Benchmark passages in training texts: a hash set of test n-grams against token windows.

A word is a run of ASCII letters and digits and of characters beyond ASCII, with
A-Z taken as a-z. The windows of an item are its runs of ``n`` words, or all its
words where it has fewer. Texts are scanned in their own partitions: every window
of a text is looked up by hash, a hit is compared word by word, and all words of
a verified window are marked.

The set of windows is broadcast while the benchmark has at most ``BROADCAST``
words. A larger one stays distributed: texts send on the windows that a bitmap
of fixed size does not rule out, and a join finds the items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_group_rows
from ..scratch import Scratch
from . import words
from .filters import bitmap, hits

WORDS = 10  # words of a window
BROADCAST = 200_000  # words of a benchmark whose windows are sent to every executor
BITS = 1 << 26  # bits of the map of windows beyond that, 8 MB

# Bytes that belong to no word.
_OUTSIDE = np.zeros(256, dtype=bool)
_OUTSIDE[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_U = np.uint64


class _Words:
    """The words of a column of texts, over one array of lower-cased bytes."""

    def __init__(self, column: pa.Array):
        data, offsets = words.text_bytes(column)
        self.data = words._LOWER[data]
        self.offsets = offsets
        self.starts, self.ends, self.owner = words.word_spans(self.data, offsets, _OUTSIDE)
        self.hashes = words.word_hashes(self.data, self.starts, self.ends)
        self.counts = np.bincount(self.owner, minlength=len(column))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``n`` words inside one text."""
        last = max(len(self.hashes) - n + 1, 0)
        with np.errstate(over="ignore"):
            out = np.zeros(last, dtype=_U)
            for i in range(n):
                out = words.mix(out * _U(3) + self.hashes[i : i + last], i + 1)
        inside = np.flatnonzero(self.owner[:last] == self.owner[n - 1 : n - 1 + last])
        return inside, out[inside].view(np.int64)

    def phrase(self, first: int, n: int) -> bytes:
        """The words of a window, parted by one space."""
        spans = zip(self.starts[first : first + n], self.ends[first : first + n], strict=True)
        return b" ".join(self.data[a:b].tobytes() for a, b in spans)


def _item_windows(n: int):
    """Rows of size, hash, phrase and item of every window of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                found = _Words(part.column(1))
                for size in range(1, n + 1):
                    first, hashes = found.windows(size)
                    if size < n:
                        whole = found.counts[found.owner[first]] == size
                        first, hashes = first[whole], hashes[whole]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(first), size), pa.int32()),
                            pa.array(hashes, pa.int64()),
                            pa.array([found.phrase(f, size) for f in first], pa.binary()),
                            part.column(0).take(pa.array(found.owner[first])),
                        ],
                        ["size", "hash", "phrase", "item"],
                    )

    return run


def _index(rows) -> tuple[dict, dict]:
    """Sorted hashes by size of window, and items by size and phrase."""
    items: dict[tuple[int, bytes], set] = {}
    by_size: dict[int, set] = {}
    for size, hashed, phrase, item in rows:
        by_size.setdefault(size, set()).add(hashed)
        items.setdefault((size, bytes(phrase)), set()).add(item)
    return {k: np.sort(np.array(list(v), np.int64)) for k, v in by_size.items()}, items


def _among(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that are among the known ones."""
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.flatnonzero(known[at] == hashes)


def _kept_text(found: _Words, original: np.ndarray, marked: np.ndarray, row: int) -> str:
    """A text without its marked words and what stands between two of them."""
    first, last = np.searchsorted(found.owner, [row, row + 1])
    at, stop = found.offsets[row], found.offsets[row + 1]
    pieces = []
    edges = np.diff(np.concatenate([[0], marked[first:last].astype(np.int8), [0]]))
    runs = zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
    for a, b in runs:
        pieces.append(original[at : found.starts[first + a]].tobytes())
        at = found.ends[first + b - 1]
    pieces.append(original[at:stop].tobytes())
    return b"".join(pieces).decode()


def _scan(shared, cleaned: bool, names: list[str]):
    """The batch's rows with number of words, hit words, items and, if asked, the text left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, phrases = shared.value
        for batch in batches:
            for part in words.slices(batch, "text"):
                column = part.column(1)
                found = _Words(column)
                edge = np.zeros(len(found.starts) + 1, np.int64)
                items: list[set] = [set() for _ in range(part.num_rows)]
                for size in known:
                    first, hashes = found.windows(size)
                    for f in first[_among(known[size], hashes)].tolist():
                        of = phrases.get((size, found.phrase(f, size)))
                        if of:
                            edge[f] += 1
                            edge[f + size] -= 1
                            items[found.owner[f]] |= of
                marked = np.cumsum(edge)[:-1] > 0
                n_hit = np.bincount(found.owner[marked], minlength=part.num_rows)
                named = [sorted(str(i) for i in s if i is not None) for s in items]
                arrays = [
                    part.column(0),
                    pa.array(found.counts, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(named, pa.list_(pa.string())),
                ]
                if cleaned:
                    original, _ = words.text_bytes(column)
                    kept = column.to_pylist()
                    for row in np.flatnonzero(n_hit).tolist():
                        kept[row] = _kept_text(found, original, marked, row)
                    arrays.append(pa.array(kept, pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _doc_windows(sizes: list[int], marked: np.ndarray):
    """Rows of text key, first word, size, hash and phrase of the windows that may be an item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                found = _Words(part.column(1))
                for size in sizes:
                    first, hashes = found.windows(size)
                    keep = hits(marked, hashes)
                    first, hashes = first[keep], hashes[keep]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(found.owner[first])),
                            pa.array(first - np.searchsorted(found.owner, found.owner[first])),
                            pa.array(np.full(len(first), size), pa.int32()),
                            pa.array(hashes, pa.int64()),
                            pa.array([found.phrase(f, size) for f in first], pa.binary()),
                        ],
                        ["key", "first", "size", "hash", "phrase"],
                    )

    return run


def _joined(texts: DataFrame, windows: DataFrame, scratch: Scratch) -> DataFrame:
    """As :func:`_scan` without the text left, for windows that are too many to broadcast."""
    marked = bitmap(windows.select("hash"), BITS)
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    keyed = texts.withColumn("key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    once = keyed.groupBy("key").agg(F.first("text").alias("text"))
    found = once.select("key", "text").mapInArrow(
        _doc_windows(sizes, marked), "key string, first long, size int, hash long, phrase binary"
    )
    by = ["size", "hash", "phrase"]
    named = F.collect_set(F.col("item").cast("string")).alias("items")
    distinct = windows.groupBy(*by).agg(named)
    met = scratch.write(found.hint("merge").join(distinct.hint("merge"), by), "met")
    covered = F.explode(F.sequence("first", F.col("first") + F.col("size") - 1))
    n_hit = met.select("key", covered.alias("at")).distinct().groupBy("key").agg(
        F.count("*").alias("n_hit")
    )
    items = met.select("key", F.explode("items").alias("item")).groupBy("key").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    counted = keyed.select("id", "key", _word_count(F.col("text")).alias("n_words"))
    out = join_group_rows(counted, n_hit, "key", "left")
    out = join_group_rows(out, items, "key", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )


def _word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    n: int = WORDS,
    cleaned: bool = False,
) -> DataFrame:
    """Per document: ``id_col, n_words, n_hit, items`` and, with ``cleaned``, ``text_left``.

    ``n_hit`` counts the words inside any occurrence of a window of the benchmark,
    ``items`` names the items of those windows as strings, in order. ``text_left``
    is the text without hit words and what stands between two of them; a text
    without hits stays as it is, null included.

    One row per input row, repeated rows and ids included. Null and empty texts
    have no words. Items without words have no window; the words of an item with
    a null id are hit, but it is not named. Empty tables give no rows or no hits.
    Other columns are ignored. Texts of any length are read whole. ``cleaned``
    needs a benchmark of ``BROADCAST`` words at most.
    """
    scratch = Scratch(docs.sparkSession, "overlaps")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    kind = items.schema["item"].dataType.simpleString()
    windows = items.mapInArrow(
        _item_windows(n), f"size int, hash long, phrase binary, item {kind}"
    )
    windows = scratch.write(windows, "windows")
    total = items.agg(F.sum(_word_count(F.col("text")))).first()[0] or 0
    if total <= BROADCAST:
        shared = docs.sparkSession.sparkContext.broadcast(_index(windows.toLocalIterator()))
        names = ["id", "n_words", "n_hit", "items", *["text_left"] * cleaned]
        schema = f"id {texts.schema['id'].dataType.simpleString()}, n_words long, n_hit long, "
        schema += "items array<string>" + ", text_left string" * cleaned
        found = texts.mapInArrow(_scan(shared, cleaned, names), schema)
    elif cleaned:
        raise ValueError(f"cleaned texts need a benchmark of at most {BROADCAST} words")
    else:
        found = _joined(texts, windows, scratch)
    return found.withColumnRenamed("id", id_col)


def without_passages(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, text`` with the passages of the benchmark cut out of the texts."""
    found = overlaps(docs, benchmark, cleaned=True, **options)
    id_col = options.get("id_col", "doc_id")
    return found.select(id_col, F.col("text_left").alias(options.get("text_col", "text")))


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, most: float = 0.0, **options
) -> DataFrame:
    """Ids of the documents of whose words at most the share ``most`` is hit."""
    found = overlaps(docs, benchmark, **options)
    return found.where(F.col("n_hit") <= F.col("n_words") * most).select(options.get("id_col", "doc_id"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What the query returns of :func:`overlaps`."""
    return found.select(
        id_col, "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_places AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
  FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM item_places),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, sizes),
met AS (
  SELECT doc_id, i, p.n, item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM places) p
  JOIN windows USING (n, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
