"""How filters of documents interact, in every order in which they may be applied.

Exact duplicates come from radix tries. Every task first merges its own copies,
so that a text leaves it once per batch with its least id. Texts are then dealt
out by ranges of an adaptive prefix: the shortest of 4, 16, 64, ... characters
that does not gather more texts than a task should have. Within a range the whole
texts go into a compressed trie whose terminals hold the least id; reading the
terminals back gives the least id of every text.

The filters of a document are the bits of a mask. Masks are counted per part,
and the audit of all orders follows from the counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_group_rows
from ..scratch import Scratch
from . import words

FILTERS = "ABCDE"
ORDERS = 120  # of five filters
LEAST_WORDS = 200
SIGNS = b"#$%&*|"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
PREFIX = 4  # characters of the shortest prefix
PART_BYTES = 16 << 20  # text bytes that a range should hold, or less if there are tasks for it


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of id, part, mask of A to D, rows back to the first copy, least id, text.

    Copies are those within a batch; only the first one carries the text, and
    all carry the least id among them.
    """
    names = ["id", "part", "mask", "back", "least", "text"]
    for batch in batches:
        for part in words.slices(batch, "text"):
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            first: dict[str, int] = {}
            at = [first.setdefault(text or "", row) for row, text in enumerate(texts)]
            least: dict[int, object] = {}
            for row, key in zip(at, ids, strict=True):
                if key is not None and (row not in least or key < least[row]):
                    least[row] = key
            masks = {row: _mask(text) for text, row in first.items()}
            kept: list[str | None] = [None] * len(texts)
            for text, row in first.items():
                kept[row] = text
            arrays = [
                part.column(0),
                part.column(2),
                pa.array([masks[row] for row in at], pa.int32()),
                pa.array([i - row for i, row in enumerate(at)], pa.int64()),
                pa.array([least.get(row) for row in at], part.column(0).type),
                pa.array(kept, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)


def _mask(text: str) -> int:
    data = text.encode()
    found = data.split()  # at the six ASCII blanks
    few = len(found) < LEAST_WORDS
    repeated = 100 * len(set(found)) < 50 * len(found)
    upper = 100 * (len(data) - len(data.translate(None, UPPER))) > 3 * len(text)
    signs = len(data.translate(None, SIGNS)) < len(data)
    return few | repeated << 1 | upper << 2 | signs << 3


class _Trie:
    """A compressed trie over bytes, as lists by node; a terminal holds the least id."""

    def __init__(self):
        self.labels: list[bytes] = [b""]
        self.kids: list[dict[int, int]] = [{}]
        self.least: list = [None]

    def _node(self, label: bytes, kids: dict[int, int]) -> int:
        self.labels.append(label)
        self.kids.append(kids)
        self.least.append(None)
        return len(self.labels) - 1

    def insert(self, text: bytes) -> int:
        """The node of the text, added where it is new."""
        node, at = 0, 0
        while at < len(text):
            child = self.kids[node].get(text[at])
            if child is None:
                self.kids[node][text[at]] = node = self._node(text[at:], {})
                return node
            label = self.labels[child]
            if not text.startswith(label, at):
                shared = _shared(label, text, at)
                upper = self._node(label[:shared], {label[shared]: child})
                self.labels[child] = label[shared:]
                self.kids[node][text[at]] = child = upper
                label = self.labels[upper]
            node, at = child, at + len(label)
        return node

    def put(self, text: bytes, key) -> int:
        node = self.insert(text)
        if key is not None and (self.least[node] is None or key < self.least[node]):
            self.least[node] = key
        return node


def _shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the common start of a label and the text from ``at``."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _smaller_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of copies and least id of the range, for copies that know of none so small."""
    trie, rows, kind = _Trie(), [], None
    for batch in batches:
        kind = batch.column(1).type
        columns = [column.to_pylist() for column in batch.columns]
        for copies, own, text in zip(*columns, strict=True):
            rows.append((copies, own, trie.put(text.encode(), own)))
    found = [(c, trie.least[node]) for c, own, node in rows if trie.least[node] != own]
    for start in range(0, len(found), 100_000):
        copies, least = zip(*found[start : start + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(copies, pa.int64()), pa.array(least, kind)], ["copies", "smaller"]
        )


def _prefixed(texts: DataFrame, part_bytes: int, scratch: Scratch) -> DataFrame:
    """Adds ``prefix``: the shortest one that is not heavy, or the longest there is.

    Each round counts the bytes under the prefixes that were too heavy so far.
    At most ``bytes / part_bytes`` prefixes of a length are heavy.
    """
    known, left, length = [], texts, PREFIX
    while True:
        weight = left.groupBy(F.substring("text", 1, length).alias("start")).agg(
            F.sum(F.octet_length("text")).alias("bytes"), F.max(F.length("text")).alias("longest")
        )
        heavy = weight.where(f"bytes > {part_bytes} AND longest > {length}").select("start")
        heavy = scratch.write(heavy, f"heavy{length}")
        if heavy.isEmpty():
            break
        known.append((length, heavy))
        left = texts.withColumn("start", F.substring("text", 1, length)).join(
            heavy, "start", "left_semi"
        )
        length *= 4
    prefix = F.substring("text", 1, length)
    rows = texts
    for size, heavy in reversed(known):
        start, is_heavy = F.substring("text", 1, size), f"heavy{size}"
        rows = rows.withColumn("start", start).join(
            heavy.withColumn(is_heavy, F.lit(True)), "start", "left"
        )
        prefix = F.when(F.col(is_heavy).isNull(), start).otherwise(prefix)
    return rows.select(*texts.columns, prefix.alias("prefix"))


def flagged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``id, part, mask`` per document; bit i of the mask is set where it fails filter i.

    A: fewer than 200 words. B: fewer distinct words than half of them. C: over
    3 % of the characters are A-Z. D: holds one of ``#$%&*|``. E: a smaller id
    has the same text. Null texts are empty, null parts the empty string. Rows
    without an id are no copies, and no row is a copy of them; rows that share
    id and text are no copies of each other. An empty table gives no rows, and
    other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), part.alias("part"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(
        _masked, f"id {kind}, part string, mask int, back long, least {kind}, text string"
    )
    # The number of the first copy in a batch stands for all of them.
    copies = F.monotonically_increasing_id() - F.col("back")
    rows = scratch.write(rows.withColumn("copies", copies).drop("back"), "rows")
    texts = rows.where("text IS NOT NULL").select("copies", "least", "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part_bytes = max(1, min(part_bytes, total // tasks))
    dealt = _prefixed(texts, part_bytes, scratch).repartitionByRange(
        max(1, -(-total // part_bytes)), "prefix"
    )
    smaller = dealt.select("copies", "least", "text").mapInArrow(
        _smaller_ids, f"copies long, smaller {kind}"
    )
    smaller = scratch.write(smaller, "smaller")
    met = rows.select("id", "part", "mask", "least", "copies").join(smaller, "copies", "left")
    copy = F.coalesce(F.col("id") > F.coalesce("smaller", "least"), F.lit(False))
    return met.select("id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def _orders() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of those before."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        for step, filter_ in enumerate(order):
            before = sum(1 << f for f in order[:step])
            name = "".join(FILTERS[f] for f in order)
            steps.append({"name": name, "step": step + 1, "bit": 1 << filter_, "before": before})
    return steps


def audit(marked: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per part, order and step what the step keeps, removes and loses.

    ``marked`` is what :func:`flagged` returns, ``labels`` has ``key``, ``quality``
    and ``toxic``. Documents without a label are never good or toxic; where a key
    has several labels, a document counts as good or toxic if one says so. A
    part's documents are counted by mask before the orders come in.
    """
    of_key = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    counted = (
        join_group_rows(marked, of_key, "id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.count_if("good").alias("good"),
            F.count_if("toxic").alias("toxic"),
        )
    )
    schema = "array<struct<name:string,step:int,bit:int,before:int>>"
    steps = F.explode(F.from_json(F.lit(json.dumps(_orders())), schema))
    rows = counted.withColumn("at", steps).select("part", "mask", "n", "good", "toxic", "at.*")
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, earlier = mask.bitwiseAND(bit) > 0, mask.bitwiseAND(before) > 0
    removed = fails & ~earlier
    failed = F.bit_count(mask)

    def total(condition, what=F.col("n")):
        return F.coalesce(F.sum(F.when(condition, what)), F.lit(0)).cast("long")

    # A document that fails m filters falls to each of them in 1/m of the orders.
    share = F.col("n") * F.floor(F.lit(ORDERS) / F.greatest(failed, F.lit(1)))
    return rows.groupBy("part", F.col("name").alias("filter_order"), "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(removed, F.col("good")).alias("good_lost"),
        total(removed, F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts),
masks AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t)
            THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS mask
  FROM firsts),
marked AS (
  SELECT part, mask, count(*) AS n,
         count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM masks LEFT JOIN labels USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || f FROM orders, letters
  WHERE length(filter_order) < 5 AND NOT contains(filter_order, f)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f,
         '[' || substr(filter_order, 1, step - 1) || '_]' AS earlier
  FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
  WHERE length(filter_order) = 5),
rows AS (
  SELECT part, filter_order, step, n, good, toxic, mask = f AS only_this,
         contains(mask, f) AS fails, regexp_matches(mask, earlier) AS gone, length(mask) AS m
  FROM marked, steps)
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (only_this), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * (120 // greatest(m, 1))) FILTER (fails), 0) AS BIGINT) AS shapley
FROM rows GROUP BY part, filter_order, step
"""
