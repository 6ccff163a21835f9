"""Spelling variants of a corpus: words one edit apart, grouped under the frequent form.

Two words that differ by one edit share all letters before it or all behind it.
So every word goes to blocks by its first half and by its last half; a block that
is still too large is cut again by half of what its words may still differ in,
down to a single position, where the alphabet bounds it.

Within blocks a bit-sliced index has a bitset over the words for every (position,
letter). All words of a block are looked up at once: a recurrence over the
positions keeps the set of words without an error so far and those with one,
a replaced letter at the same position or an inserted one at the next.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import words
from .ngram_join import _runs

LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5  # a form occurs so many times as often as its variant
SLIPS = 199  # one of so many words per document loses a letter
BLOCK = 50_000  # words of a block that is not cut again
PACKED = 2048  # words of small blocks looked up together
CELLS = 1 << 18  # 64-bit words of one state of the recurrence
COUNTED = 300_000  # distinct words a task counts before it hands them on

LETTERS = "A-Za-zÀ-ÿ"


def _counted(least_length: int, slips: int | None):
    """Rows of word and occurrences, added up within a task."""
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def slipped(run: str, start: int) -> str:
        crc = zlib.crc32(run.encode(), start)
        if crc % slips:
            return run
        at = crc % len(run)
        return run[:at] + run[at + 1 :]

    def out(counts: Counter) -> pa.RecordBatch:
        arrays = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in words.slices(batch, "text"):
                for key, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    # Lowering bytes touches A-Z only.
                    found = Counter(runs.findall((text or "").encode().lower().decode()))
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, n in found.items():
                        word = slipped(word, start) if slips else word
                        if len(word) >= least_length:
                            counts[word] += n
                    if len(counts) > COUNTED:
                        yield out(counts)
                        counts = Counter()
        yield out(counts)

    return run


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    slips: int | None = None,
) -> DataFrame:
    """``word, n``: runs of Latin letters, A-Z lowered, with enough letters and occurrences.

    ``slips`` takes a letter out of one of so many distinct runs of a document,
    by the CRC-32 of ``id:run``. Null and empty texts have no words; a null id is
    an empty one. Repeated rows count each, other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_counted(least_length, slips), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {least_count}")


_KEY = ["short", "before", "behind", "head", "tail"]


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice: the edit lies behind the first half of what may differ, or before."""
    open_ = F.col("short") - F.col("before") - F.col("behind")
    half = F.floor(open_ / 2).cast("int")
    sides = F.array(
        F.struct((F.col("before") + half).alias("before"), F.col("behind").alias("behind")),
        F.struct(F.col("before").alias("before"), (F.col("behind") + open_ - half).alias("behind")),
    )
    rows = rows.select("word", "short", F.explode(sides).alias("side")).select(
        "word", "short", "side.before", "side.behind"
    )
    return rows.withColumn("head", F.substring("word", F.lit(1), F.col("before"))).withColumn(
        "tail", F.right(F.col("word"), F.col("behind"))
    )


def _blocks(vocab: DataFrame, least: int, block: int, scratch: Scratch) -> DataFrame:
    """``short, block, word``: blocks of words of the lengths ``short`` and ``short + 1``.

    Any two words one edit apart meet in a block for the length of the shorter one.
    """
    size = F.length("word")
    shorter = F.explode(F.array(size, size - 1)).alias("short")
    none = F.lit(0).alias("before"), F.lit(0).alias("behind")
    rows = vocab.select("word", shorter).where(f"short >= {least}").select("*", *none)
    left, settled, number = _halved(rows), None, 0
    while True:
        left = scratch.write(left, f"blocks{number}")
        sizes = left.groupBy(*_KEY).agg(F.count("*").alias("size"))
        large = sizes.where(f"size > {block} AND short - before - behind > 1").select(*_KEY)
        large = scratch.write(large, f"large{number}")
        done = large.isEmpty()
        kept = left if done else left.join(large, _KEY, "left_anti")
        kept = kept.select("short", F.xxhash64(*_KEY).alias("block"), "word")
        settled = kept if settled is None else settled.union(kept)
        if done:
            return settled
        left, number = _halved(left.join(large, _KEY, "left_semi")), number + 1


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    width = -(-rows.shape[1] // 64) * 8
    packed = np.packbits(rows, axis=1, bitorder="little")
    out = np.zeros((len(rows), width), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _near_pairs(found: list[str], blocks: np.ndarray, short: int) -> Iterator[tuple]:
    """Places of words and of words one edit away in the same block, shorter ones first."""
    size = np.array([len(w) for w in found])
    codes = np.zeros((len(found), short + 1), np.uint32)
    for length in (short, short + 1):
        at = np.flatnonzero(size == length)
        text = "".join(found[i] for i in at).encode("utf-32-le")
        codes[at, :length] = np.frombuffer(text, np.uint32).reshape(len(at), length)
    alike, longer = _bits((size == short)[None]), _bits((size == short + 1)[None])
    index, place = [], np.zeros(codes.shape, np.int64)
    letters = [np.unique(codes[:, i]) for i in range(short + 1)]
    for i, known in enumerate(letters):
        # The last row is for letters that no word has here.
        index.append(_bits(np.vstack([known[:, None] == codes[None, :, i], np.zeros(len(found), bool)])))

    def bitsets(i: int, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(letters[i], wanted), len(letters[i]) - 1)
        return index[i][np.where(letters[i][at] == wanted, at, len(letters[i]))]

    asked = np.flatnonzero(size == short)
    step = max(1, CELLS // alike.shape[1])
    for start in range(0, len(asked), step):
        some = asked[start : start + step]
        zero = _bits(blocks[some][:, None] == blocks[None])
        replaced, inserted = np.zeros_like(zero), np.zeros_like(zero)
        for i in range(short):
            letter = codes[some, i]
            here = bitsets(i, letter)
            replaced = (replaced & here) | (zero & ~here)
            inserted = (inserted | zero) & bitsets(i + 1, letter)
            zero &= here
        near = (replaced & alike) | ((inserted | zero) & longer)
        row, column = np.nonzero(near)
        bit = np.unpackbits(
            near[row, column].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        which, offset = np.nonzero(bit)
        yield some[row[which]], column[which] * 64 + offset


_PAIR = pa.schema([("word", pa.string()), ("near", pa.string())])


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of words one edit apart, both ways, from whole blocks sorted by length and block."""
    for table, cuts in _runs(batches, ["short", "block"]):
        short, blocks = table.column("short").to_numpy(), table.column("block").to_numpy()
        column = table.column("word")
        start = 0
        for here, stop in zip(cuts[1:], [*cuts[2:], None], strict=True):
            full = stop is None or stop - start > PACKED or short[here] != short[start]
            if not full:
                continue
            found = column.slice(start, here - start)
            if len(found) > 1:
                pairs = _near_pairs(found.to_pylist(), blocks[start:here], int(short[start]))
                for one, two in pairs:
                    u, v = found.take(pa.array(one)), found.take(pa.array(two))
                    for a, b in ((u, v), (v, u)):
                        rows = pa.Table.from_arrays([a, b], schema=_PAIR)
                        yield from rows.combine_chunks().to_batches(max_chunksize=100_000)
            start = here


def near_words(
    vocab: DataFrame, least: int = LEAST_LENGTH, block: int = BLOCK, scratch: Scratch | None = None
) -> DataFrame:
    """``word, near``: all pairs of words, both ways, one edit apart.

    An edit inserts, deletes or replaces one code point. ``vocab`` has every word
    once, of ``least`` code points or more.
    """
    scratch = scratch or Scratch(vocab.sparkSession, "near")
    dealt = _blocks(vocab.select("word"), least, block, scratch)
    dealt = dealt.repartition("short", "block").sortWithinPartitions("short", "block")
    return dealt.mapInArrow(_looked_up, "word string, near string").distinct()


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    slips: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of :func:`vocabulary`.

    The form is the near word of largest ``n``, ties to the smallest in code-point
    order, if it occurs ``times`` times as often as the word; else null. The root
    is the last of the forms from the word on. Rounds to find roots grow with the
    logarithm of the longest chain, which counts that grow by ``times`` keep short.
    An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    vocab = vocabulary(docs, id_col, text_col, least_length, least_count, slips)
    vocab = scratch.write(vocab, "vocabulary")
    near = near_words(vocab, least_length, block, scratch)
    counts = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best")
    )
    often = -F.col("best.col1") >= times * F.col("n")
    known = vocab.join(best, "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"),
        F.when(often, -F.col("best.col1")).alias("form_n"),
    )
    known = scratch.write(known, "known")
    chain = scratch.write(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "chain0")
    number = 0
    while True:
        number += 1
        after = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = chain.join(after, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = scratch.write(moved, f"chain{number}")
        chain = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return known.join(chain, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT [list_reduce([i] || range(8), lambda c, k:
            CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
          FOR i IN range(256)] AS t),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
runs AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
  FROM found GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(
           [4294967295] || [CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT) FOR k IN range(length(h) // 2)],
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM runs, crc_table),
spelled AS (
  SELECT n, CASE WHEN crc % 199 = 0
           THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2)
           ELSE run END AS word
  FROM hashed),
vocab AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, p, left(word, p) || substr(word, p + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS p FROM vocab)),
pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b USING (p, rest) WHERE a.word <> b.word
  UNION
  SELECT v.word, c.word FROM vocab v JOIN cut c ON c.rest = v.word
  UNION
  SELECT c.word, v.word FROM vocab v JOIN cut c ON c.rest = v.word),
ranked AS (
  SELECT p.word, near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, near) AS r
  FROM pairs p JOIN vocab v ON v.word = near),
known AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 5 * n THEN near END AS form,
         CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM vocab v LEFT JOIN ranked ON ranked.word = v.word AND r = 1),
chain AS (
  SELECT word, word AS last FROM known
  UNION
  SELECT c.word, k.form FROM chain c JOIN known k ON k.word = c.last WHERE k.form IS NOT NULL)
SELECT k.word, k.form, c.last AS root, k.n, k.n_near, k.form_n
FROM known k JOIN chain c USING (word) JOIN known e ON e.word = c.last AND e.form IS NULL
"""
