"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .mixing import word_count

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16  # cost of a sequence besides its length
GROUP = 20_000  # pieces packed together, as an expected number
BIN_BITS = 24  # of a bin number, the rest numbers the group


def best_fit(
    sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD
) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and the length of each bin; sizes descend.

    A piece goes to the open bin that it leaves with the least room. If none has
    room, a bin is opened with the length of least cost, as :func:`_opener` expects
    it from the sizes that remain. In the end each bin shrinks to the least length
    that holds it. The same is done with every single length as the only one opened
    for pieces that fit it, and the packing whose bins cost least in all is returned,
    the mixed one first.
    """
    capacities = sorted(capacities)
    found = _packing(sizes, capacities, _opener(sizes, capacities, overhead))
    for fixed in capacities:

        def open_fixed(at: int, room: int, fixed: int = fixed) -> int:
            return max(fixed, _least(capacities, sizes[at]))

        found = min(found, _packing(sizes, capacities, open_fixed), key=lambda p: cost(p[2], overhead))
    return found


def cost(lengths: Sequence[int], overhead: int = OVERHEAD) -> int:
    """What bins of these lengths cost."""
    return sum(lengths) + overhead * len(lengths)


def _least(capacities: Sequence[int], size: int) -> int:
    return capacities[bisect_left(capacities, size)]


def _packing(
    sizes: Sequence[int], capacities: Sequence[int], opened: Callable[[int, int], int]
) -> tuple[list[int], list[int], list[int]]:
    """Best fit with downsizing; ``opened(at, room)`` gives the length of a bin for ``sizes[at]``.

    ``room`` is what all open bins can still hold.
    """
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    bins, offsets, used = [], [], []
    open_room = 0
    for i, size in enumerate(sizes):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room = opened(i, open_room)
            open_room += room
            number = len(used)
            used.append(0)
        bins.append(number)
        offsets.append(used[number])
        used[number] += size
        open_room -= size
        if room > size:
            insort(rooms, (room - size, number))
    return bins, offsets, [_least(capacities, u) for u in used]


def _opener(
    sizes: Sequence[int], capacities: Sequence[int], overhead: int
) -> Callable[[int, int], int]:
    """Chooses the length that is expected to cost least per word it will hold.

    What a length will hold is the piece, and of the smaller ones still to come
    the largest that fit one after another, but no more words than the open
    bins leave over. Its cost is that of the length it will shrink to.
    """
    kinds = sorted(set(sizes))
    counts = Counter(sizes)
    left = sum(sizes)
    done = 0

    def filled(room: int) -> int:
        words, at = 0, bisect_right(kinds, room) - 1
        while at >= 0:
            taken = min(counts[kinds[at]], room // kinds[at]) * kinds[at]
            words += taken
            room -= taken
            at = bisect_right(kinds, room, 0, at) - 1
        return words

    def opened(at: int, open_room: int) -> int:
        nonlocal left, done
        for size in sizes[done : at + 1]:
            counts[size] -= 1
            left -= size
        done = at + 1
        size, over = sizes[at], max(0, left - open_room)

        def expected(length: int) -> tuple[float, int]:
            words = size + min(filled(length - size), over)
            return (_least(capacities, words) + overhead) / words, length

        return min((c for c in capacities if c >= size), key=expected)

    return opened


def _packed(capacities: Sequence[int], overhead: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n_words", "row", "piece"], ascending=[False, True, True])
        bins, offsets, lengths = best_fit(frame["n_words"].tolist(), capacities, overhead)
        frame["bin_id"] = (frame["pack"].to_numpy() << BIN_BITS) + bins
        frame["bin_offset"] = offsets
        frame["bin_length"] = [lengths[b] for b in bins]
        return frame.drop(columns=["pack"])

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD,
    group: int = GROUP,
) -> DataFrame:
    """Where each document goes: one row per piece.

    Returns the id column, ``piece``, ``start`` and ``n_words`` (the piece's
    place in the document, in words), ``bin_id``, ``bin_offset`` and
    ``bin_length`` (one of ``capacities``). A document longer than the largest
    length is cut into pieces of that length and a rest; no word is dropped.

    Pieces are dealt to groups of about ``group`` at random and each group is
    packed on its own by :func:`best_fit`, so no task holds more. Numbers of rows,
    given when the sizes are written, make up for repeated and null ids. Null and
    empty texts give one piece of 0 words without a bin; other columns are
    ignored, and an empty table gives no rows.
    """
    largest = max(capacities)
    sizes = docs.select(F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"))
    sizes = sizes.withColumn("row", F.monotonically_increasing_id())
    sizes = Scratch(docs.sparkSession, "pack").write(sizes, "sizes")
    whole = F.greatest(F.lit(1), F.ceil(F.col("size") / largest))
    facts = sizes.agg(F.sum(whole)).first()
    groups = max(1, -(-(facts[0] or 0) // group))
    pieces = sizes.select(
        "id", "row", "size", F.explode(F.sequence(F.lit(0), (whole - 1).cast("int"))).alias("piece")
    ).select(
        F.col("id").alias(id_col), "row", "piece",
        (F.col("piece").cast("long") * largest).alias("start"),
        F.least(F.lit(largest), F.col("size") - F.col("piece").cast("long") * largest).alias("n_words"),
    )
    full = pieces.where("n_words > 0").withColumn(
        "pack", F.pmod(F.xxhash64("row", "piece"), F.lit(groups))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    places = "bin_id long, bin_offset long, bin_length int"
    packed = full.groupBy("pack").applyInPandas(
        _packed(tuple(capacities), overhead),
        f"`{id_col}` {kind}, row long, piece int, start long, n_words long, {places}",
    )
    bare = pieces.where("n_words = 0").select(
        "*", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("bin_offset"),
        F.lit(None).cast("int").alias("bin_length"),
    )
    return packed.unionByName(bare).drop("row")
