"""Similar documents by the Jaccard measure of their word shingles, exactly.

A size-aware join. Texts with the same shingle set form a class first. Classes
up to a boundary size enumerate subsets of a fixed size: two sets that share one
of the required size are similar by definition, so no check follows. Larger
classes scan inverted lists of the few shingles in which similar sets must meet;
shingles that are frequent come last in the order, so that lists stay short. The
boundary is the one with the least total of enumerated subsets and scanned list
entries.

Counts that settle the order are taken over the first shingles by hash of every
set, enough for most prefixes; sets in which too few of those are rare are read
whole. Candidates are compared by bit signatures whose distance never exceeds the sets'
difference, so no link is lost; what remains is checked on the sets themselves,
first one pair per set and then the pairs that are not connected by then.

Long lists do that by size of set and in three passes. The first compares within
blocks and hands on one partner per member. The others take the lists that still
hold several components, and compare the members outside the largest component
with all others: first handing on one partner per component, then every pair. So
a large group of near copies costs its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_group_rows
from ..scratch import Scratch
from . import words
from .components import components
from .filters import bitmap, hits

SHINGLE = 3
PERCENT = 90
RARE = 16  # shingles counted more often come later in the order, by powers of two
SHORT = 32  # lists up to this length hand on pairs of numbers, longer ones compare signatures
BLOCK = 512  # members of a long list compared in one go
HEAD = 28  # shingles of a head at least


def least_overlap(a: int, b: int, percent: int) -> int:
    """The overlap that sets of sizes ``a`` and ``b`` need to be similar."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of size ``n`` among which it meets any similar set."""
    return n - -(-percent * n // 100) + 1


def _subset_plan(n: int, boundary: int, percent: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, shingles left out) of each subset family of a set."""
    plan = []
    for other in range(1, boundary + 1):
        a, b = min(n, other), max(n, other)
        need = least_overlap(a, b, percent)
        if need <= a and (a, b, need) != (n, n, n):
            plan.append((a, b, n - need))
    return plan


def _subset_count(n: int, boundary: int, percent: int) -> int:
    return sum(math.comb(n, left) for _, _, left in _subset_plan(n, boundary, percent))


def _signature(values: np.ndarray) -> bytes:
    """Parity bits of the hashed members; sets that differ in d members differ in d bits at most."""
    bits = 64
    while bits < 2 * len(values):
        bits *= 2
    at = (words.mix(values, 3) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1).tobytes()


def _keys(values: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A 128-bit key of each set, from sums that no order changes."""
    with np.errstate(over="ignore"):
        sums = np.zeros((len(values) + 1, 2), np.uint64)
        np.cumsum(words.mix(values, 1), out=sums[1:, 0])
        np.cumsum(words.mix(values, 2), out=sums[1:, 1])
        return [x.tobytes() for x in sums[offsets[1:]] - sums[offsets[:-1]]]


def _sets(k: int, percent: int):
    """Rows of id, size, key of the set, first shingles by hash, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                values, offsets = words.shingle_sets(part.column(1), k)
                sizes = np.diff(offsets)
                heads, signatures = [], []
                for start, stop, n in zip(offsets[:-1], offsets[1:], sizes, strict=True):
                    first = prefix_length(int(n), percent)
                    first = max(first + first // 4 + 8, HEAD)
                    heads.append(values[start : min(stop, start + first)].view(np.int64))
                    signatures.append(_signature(values[start:stop]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(_keys(values, offsets), pa.binary()),
                        pa.array(heads, pa.list_(pa.int64())),
                        pa.array(signatures, pa.binary()),
                    ],
                    ["id", "n", "key", "head", "signature"],
                )

    return run


def _whole_sets(k: int, wanted: np.ndarray):
    """Rows of id, key and whole set, for the ids whose hash is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = hits(wanted, batch.column(2).to_numpy(zero_copy_only=False))
            for part in words.slices(batch.filter(pa.array(keep)), "text"):
                values, offsets = words.shingle_sets(part.column(1), k)
                signed = values.view(np.int64)
                sets = [signed[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(_keys(values, offsets), pa.binary()),
                        pa.array(sets, pa.list_(pa.int64())),
                    ],
                    ["id", "key", "members"],
                )

    return run


def _fetch(texts: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """``uid, members`` of the given classes, from their texts.

    A bitmap of fixed size spares most other texts the work; the join decides.
    """
    marked = bitmap(reps.select(F.xxhash64("id").alias("hash")))
    kind = texts.schema["id"].dataType.simpleString()
    sets = texts.select("id", "text", F.xxhash64("id").alias("hash")).mapInArrow(
        words.releasing(_whole_sets(k, marked)), f"id {kind}, key binary, members array<long>"
    )
    return sets.join(reps, ["id", "key"]).select("uid", "members")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All members of a list column, and where each row starts."""
    lengths = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    return lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])


def _frequent_rows(frequent: np.ndarray):
    """Rows of uid, size, length of the head, place and token, for marked tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, starts = _flat(batch.column(2))
            lengths = np.diff(starts)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            keep = hits(frequent, tokens)
            place = (np.arange(len(tokens)) - starts[owner])[keep]
            owner = owner[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column(0).to_numpy()[owner], pa.int64()),
                    pa.array(batch.column(1).to_numpy()[owner], pa.int64()),
                    pa.array(lengths[owner], pa.int32()),
                    pa.array(place, pa.int32()),
                    pa.array(tokens[keep], pa.int64()),
                ],
                ["uid", "n", "length", "place", "token"],
            )

    return run


def _prefix_entries(percent: int, shared: np.ndarray | None, apart: np.ndarray | None = None):
    """Rows of uid, size and token: the marked ones among a set's first in the order.

    Sets whose uid is marked in ``apart`` are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if apart is not None:
                batch = batch.filter(pa.array(~hits(apart, batch.column(0).to_numpy())))
            heads, starts = _flat(batch.column(2))
            n, chosen = batch.column(1).to_numpy(), []
            for row, known in enumerate(batch.column(3).to_pylist()):
                tokens = heads[starts[row] : starts[row + 1]]
                need = prefix_length(int(n[row]), percent)
                if known:
                    level = np.zeros(len(tokens), np.int64)
                    level[[x["place"] for x in known]] = [x["level"] for x in known]
                    tokens = tokens[np.argsort(level, kind="stable")]
                chosen.append(tokens[:need])
            lengths = [len(x) for x in chosen]
            tokens = np.concatenate([np.zeros(0, np.int64), *chosen])
            keep = np.ones(len(tokens), bool) if shared is None else hits(shared, tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), lengths)[keep], pa.int64()),
                    pa.array(np.repeat(n, lengths)[keep], pa.int64()),
                    pa.array(tokens[keep], pa.int64()),
                ],
                ["uid", "n", "token"],
            )

    return run


def _marked(uids: np.ndarray):
    """The rows whose uid is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(hits(uids, batch.column(0).to_numpy())))

    return run


_SUBSET = pa.schema(
    [
        ("a", pa.int32()),
        ("b", pa.int32()),
        ("larger", pa.int32()),
        ("subset", pa.binary()),
        ("uid", pa.int64()),
    ]
)


def _subsets(boundary: int, percent: int):
    """Rows of family, subset hash and uid for light sets, whose head is the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: [] for name in _SUBSET.names}
            for uid, n, head in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.array(head, np.int64).view(np.uint64)
                one, two = words.mix(values, 11), words.mix(values, 12)
                for a, b, left in _subset_plan(n, boundary, percent):
                    out = np.array(list(combinations(range(n), left)), np.int64)
                    out = out.reshape(math.comb(n, left), left)
                    with np.errstate(over="ignore"):
                        x = one.sum() - one[out].sum(axis=1)
                        y = two.sum() - two[out].sum(axis=1)
                    subsets = np.stack([x, y], axis=1)
                    rows["subset"] += [s.tobytes() for s in subsets]
                    rows["a"] += [a] * len(out)
                    rows["b"] += [b] * len(out)
                    rows["larger"] += [int(n == b)] * len(out)
                    rows["uid"] += [uid] * len(out)
                if len(rows["uid"]) > 100_000:
                    yield pa.RecordBatch.from_pydict(rows, _SUBSET)
                    rows = {name: [] for name in _SUBSET.names}
            yield pa.RecordBatch.from_pydict(rows, _SUBSET)

    return run


def _folded(signature: np.ndarray, width: int) -> np.ndarray:
    while signature.shape[1] > width:
        half = signature.shape[1] // 2
        signature = signature[:, :half] ^ signature[:, half:]
    return signature


def _close_pairs(n, signatures, sides, upper, parts, boundary, percent, keep):
    """Index pairs of one block whose signatures allow them to be similar.

    Pairs of one component are left out, and those of two sets of the upper size
    step. ``keep`` says which pairs follow: ``each`` set with its closest smaller
    one, its closest one in each ``component``, or ``all``.
    """
    order = np.lexsort((np.arange(len(n)), n))
    n, sides, upper, parts = n[order], sides[order], upper[order], parts[order]
    widths = np.array([len(signatures[i]) for i in order])
    grouped = {}
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        rows = np.frombuffer(b"".join(signatures[order[i]] for i in at), np.uint8)
        grouped[int(width)] = (at, rows.reshape(len(at), -1).view(np.uint64))
    least, partner = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), -1)
    closest: dict[tuple[int, int], tuple[int, int]] = {}
    for width, (at, rows) in grouped.items():
        for wide, (at_wide, rows_wide) in grouped.items():
            if wide < width:
                continue
            folded = _folded(rows_wide, rows.shape[1])
            top = np.searchsorted(n[at_wide], n[at] * 100 // percent, side="right")
            low = np.searchsorted(at_wide, at, side="right")
            for x in np.flatnonzero(top > low):
                span = slice(low[x], top[x])
                others, i = at_wide[span], int(at[x])
                allowed = (n[i] + n[others]) * (100 - percent) // (100 + percent)
                distance = np.bitwise_count(rows[x] ^ folded[span]).sum(axis=1, dtype=np.int64)
                good = (distance <= allowed) & (n[others] > boundary)
                good &= (sides[others] != sides[i]) | (sides[i] == 2)
                good &= (parts[others] != parts[i]) & ~(upper[others] & upper[i])
                if keep == "each":
                    good &= distance < least[others]
                    least[others[good]], partner[others[good]] = distance[good], i
                    continue
                for j, d in zip(others[good].tolist(), distance[good].tolist(), strict=True):
                    if keep == "all":
                        yield int(order[i]), int(order[j])
                        continue
                    for a, b in ((i, j), (j, i)):
                        key = a, int(parts[b])
                        if key not in closest or d < closest[key][1]:
                            closest[key] = (b, d)
    for j in np.flatnonzero(partner >= 0):
        yield int(order[partner[j]]), int(order[j])
    for (a, _), (b, _) in closest.items():
        yield int(order[a]), int(order[b])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list]]:
    """Tables of whole runs of equal keys with their cuts; rows arrive sorted by the keys."""

    def cut(table: pa.Table) -> tuple[pa.Table, list]:
        ids = np.stack([table.column(c).to_numpy() for c in keys])
        cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
        return table, [0, *cuts.tolist(), table.num_rows]

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if table.num_rows == 0:
            continue
        ids = [table.column(c).to_numpy() for c in keys]
        same = np.logical_and.reduce([x == x[-1] for x in ids])
        start = 0 if same.all() else table.num_rows - int(np.argmin(same[::-1]))
        if start:
            yield cut(table.slice(0, start))
        rest = table.slice(start)
    if rest is not None and rest.num_rows:
        yield cut(rest)


_PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _scan(boundary: int, percent: int, keep: str):
    """Pairs of sets from blocks of long lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in _runs(batches, _BLOCK_KEY):
            names = ("n", "side", "upper", "part", "uid")
            n, side, upper, parts, uids = (table.column(c).to_numpy() for c in names)
            u, v = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1:
                    signatures = table.column("signature").slice(a, b - a).to_pylist()
                    for x, y in _close_pairs(
                        n[a:b], signatures, side[a:b], upper[a:b], parts[a:b], boundary, percent, keep
                    ):
                        u.append(uids[a + x])
                        v.append(uids[a + y])
            for start in range(0, len(u), 100_000):
                stop = start + 100_000
                yield pa.RecordBatch.from_pydict({"u": u[start:stop], "v": v[start:stop]}, _PAIR)

    return run


def _scan_short(boundary: int, percent: int):
    """Pairs of sets of fitting sizes from short lists, smaller number first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in _runs(batches, ["token"]):
            n, uids = table.column("n").to_numpy(), table.column("uid").to_numpy()
            length = np.diff(cuts)
            first = np.repeat(np.array(cuts[:-1]), length)
            u, v = [], []
            # Each entry with the one a few places before it in its list.
            for back in range(1, int(length.max(initial=0))):
                at = np.flatnonzero(np.arange(len(n)) - back >= first)
                low, high = np.minimum(n[at], n[at - back]), np.maximum(n[at], n[at - back])
                at = at[(high > boundary) & (low * 100 >= high * percent)]
                u.append(np.minimum(uids[at], uids[at - back]))
                v.append(np.maximum(uids[at], uids[at - back]))
            if u:
                arrays = [pa.array(np.concatenate(u)), pa.array(np.concatenate(v))]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PAIR)

    return run


def _near(percent: int):
    """The pairs whose signatures allow them to be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            allowed = sizes * (100 - percent) // (100 + percent)
            keep = np.zeros(batch.num_rows, bool)
            both = zip(batch.column("x"), batch.column("y"), strict=True)
            for row, (x, y) in enumerate(both):
                x = np.frombuffer(x.as_buffer(), np.uint64)[None]
                y = np.frombuffer(y.as_buffer(), np.uint64)[None]
                width = min(x.shape[1], y.shape[1])
                distance = np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum()
                keep[row] = distance <= allowed[row]
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return run


_SET = "uid long, n long, head array<long>"
_ENTRY = "uid long, n long, token long"


def _frequent(sets: DataFrame, levels: DataFrame) -> DataFrame:
    """Places and levels of the frequent tokens in each head that has one."""
    marked = bitmap(levels.select(F.col("token").alias("hash")))
    rows = sets.select("uid", "n", "head").mapInArrow(
        words.releasing(_frequent_rows(marked)), "uid long, n long, length int, place int, token long"
    )
    return (
        rows.hint("merge")
        .join(levels.hint("merge"), "token")
        .groupBy("uid")
        .agg(
            F.first("n").alias("n"),
            F.first("length").alias("length"),
            F.collect_list(F.struct("place", "level")).alias("known"),
        )
    )


def _entries(sets: DataFrame, frequent: DataFrame, shared: np.ndarray | None, percent: int):
    """Prefix entries; only heads with frequent tokens are shuffled to meet their levels."""
    uids = bitmap(frequent.select(F.col("uid").alias("hash")))
    sets = sets.select("uid", "n", "head")
    with_known = sets.mapInArrow(words.releasing(_marked(uids)), _SET).join(
        frequent.select("uid", "known"), "uid", "left"
    )
    plain = F.lit(None).cast("array<struct<place:int,level:int>>")
    without = sets.withColumn("known", plain).mapInArrow(
        words.releasing(_prefix_entries(percent, shared, uids)), _ENTRY
    )
    run = _prefix_entries(percent, shared)
    return with_known.select("uid", "n", "head", "known").mapInArrow(words.releasing(run), _ENTRY).union(without)


def _lists(classes: DataFrame, reps: DataFrame, texts: DataFrame, k: int, percent: int, scratch):
    """Inverted lists with more than one entry: ``token, uid, n, length``."""
    counts = classes.select(F.explode("head").alias("token")).groupBy("token").count()
    level = F.when(F.col("count") > RARE, F.floor(F.log2("count"))).otherwise(0).cast("int")
    counted = counts.where("count > 1").select("token", level.alias("level"))
    counted = scratch.write(counted, "counted")
    levels = counted.where("level > 0")
    frequent = scratch.write(_frequent(classes, levels), "frequent")
    # Heads with too few rare tokens do not settle the prefix: those sets are read whole.
    need = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    few = F.col("length") - F.size("known") < need
    short = frequent.where((F.col("length") < F.col("n")) & few).select("uid")
    whole = _fetch(texts, reps.join(short, "uid", "left_semi"), k).select(
        "uid", F.size("members").cast("long").alias("n"), F.col("members").alias("head")
    )
    whole = scratch.write(whole.dropDuplicates(["uid"]), "whole")
    known = scratch.write(_frequent(whole, levels), "known")
    late = scratch.write(_entries(whole, known, None, percent), "late")
    # What those list behind their heads is listed by the other sets as well.
    shared = bitmap(counted.select(F.col("token").alias("hash")))
    shared = shared | bitmap(late.select(F.col("token").alias("hash")))
    settled = _entries(classes, frequent, shared, percent).join(short, "uid", "left_anti")
    entries = scratch.write(settled.union(late), "entries")
    lengths = entries.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
    return scratch.write(join_group_rows(entries, lengths, "token"), "lists")


def _boundary(classes: DataFrame, scans: DataFrame, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning lists.

    Sizes are tried upwards until the subsets alone cost more than all scans.
    """
    small = classes.groupBy("n").agg(F.count("*").alias("sets"))
    cost = scans.groupBy("n").agg(F.sum("length").alias("scanned"))
    rows = {r["n"]: r for r in small.join(cost, "n", "left").collect()}  # one per size of set
    left = sum(r["scanned"] or 0 for r in rows.values())
    best, least = 0, left
    for boundary in sorted(rows):
        # A set has 2 to the power of the shingles left out, or more, subsets.
        if boundary - least_overlap(boundary, boundary, percent) >= 64:
            break
        left -= rows[boundary]["scanned"] or 0
        light = sum(
            rows[n]["sets"] * _subset_count(n, boundary, percent) for n in rows if n <= boundary
        )
        if light > least:
            break
        if light + left < least:
            best, least = boundary, light + left
    return best


def _light_links(
    classes: DataFrame, reps: DataFrame, texts: DataFrame, k: int, boundary: int, percent: int
) -> DataFrame:
    """Each set with the smallest uid that shares a subset of the required size with it."""
    family = ["a", "b", "subset"]
    light = classes.where(f"n <= {boundary}").select("uid", "n", "head")
    if boundary > HEAD:
        cut = light.where("size(head) < n").select("uid")
        whole = _fetch(texts, reps.join(cut, "uid", "left_semi"), k).select(
            "uid", F.size("members").cast("long").alias("n"), F.col("members").alias("head")
        )
        light = light.where("size(head) >= n").union(whole)
    subsets = light.mapInArrow(
        words.releasing(_subsets(boundary, percent)), "a int, b int, larger int, subset binary, uid long"
    )
    groups = subsets.groupBy(*family).agg(
        F.min("uid").alias("v"), F.max("larger").alias("high"), F.min("larger").alias("low"),
        F.count("*").alias("members"),
    )
    met = groups.where("members > 1 AND (a = b OR high <> low)").select(*family, "v")
    return (
        subsets.hint("merge").join(met.hint("merge"), family).where("uid <> v")
        .select(F.col("uid").alias("u"), "v")
    )


_BLOCK_KEY = ["token", "step", "i", "j"]
_MEMBER = [*_BLOCK_KEY, "side", "upper", "n", "uid", "signature", "part"]


def _size_step(percent: int) -> Column:
    """A number of the size of a set; similar sets have the same or the next one."""
    if percent == 100:
        return F.col("n")
    return F.floor(F.log("n") / (1.001 * math.log(100 / percent)))


def _within(lists: DataFrame) -> DataFrame:
    """The members of long lists, each in one block of its list and size step."""
    lists = lists.withColumn("of", F.struct("token", "step"))
    sizes = lists.groupBy("of").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = F.pmod(F.xxhash64("uid", "token"), F.col("blocks")).cast("int")
    return join_group_rows(lists, sizes, "of").select(
        "token", "step", dealt.alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"),
        F.lit(False).alias("upper"), "n", "uid", "signature", F.col("uid").alias("part"),
    )


def _split(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """The size windows of long lists that hold several components, by member.

    A window has the sets of one size step and the next. ``parts`` has the
    component of every set that has one beside its own.
    """
    known = parts.select(F.col("node").alias("uid"), F.col("component").alias("known"))
    rows = lists.join(known, "uid", "left").withColumn("part", F.coalesce("known", "uid"))
    window = F.explode(F.array(F.col("step"), F.col("step") - 1)).alias("window")
    rows = rows.select("*", window).withColumn("of", F.struct("token", "window"))
    counts = rows.groupBy("of", "part").agg(F.count("*").alias("members"))
    facts = counts.groupBy("of").agg(
        F.max(F.struct("members", "part")).alias("big"), F.sum("members").alias("all"),
    )
    facts = facts.where("big.members < all").select(
        "of", F.col("big.part").alias("most"),
        F.ceil(F.col("big.members") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("big.members")) / BLOCK).cast("int").alias("others"),
    )
    return join_group_rows(rows, facts, "of").select(
        "token", F.col("window").alias("step"), (F.col("step") > F.col("window")).alias("upper"),
        "n", "uid", "signature", "part", "most", "blocks", "others",
    )


def _across(split: DataFrame) -> DataFrame:
    """Blocks of the largest component with all other members, and those among themselves."""
    own = F.pmod(F.xxhash64("uid", "token"), F.col("blocks")).cast("int")
    inside = F.struct(own.alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"))
    beside = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.struct(i.alias("i"), F.lit(-1).alias("j"), F.lit(1).alias("side")),
    )
    mine = F.pmod(F.xxhash64("uid"), F.col("others")).cast("int")
    among = F.transform(
        F.sequence(F.lit(0), F.col("others") - 1),
        lambda other: F.struct(
            F.least(other, mine).alias("i"),
            F.greatest(other, mine).alias("j"),
            F.when(other == mine, 2).when(other > mine, 0).otherwise(1).alias("side"),
        ),
    )
    at = F.when(F.col("part") == F.col("most"), F.array(inside)).otherwise(F.concat(beside, among))
    return split.withColumn("at", F.explode(at)).select(
        "token", "step", "at.*", "upper", "n", "uid", "signature", "part"
    )


def _long_pairs(members: DataFrame, boundary: int, percent: int, keep: str) -> DataFrame:
    return (
        members.select(*_MEMBER)
        .repartition(*_BLOCK_KEY)
        .sortWithinPartitions(*_BLOCK_KEY)
        .mapInArrow(words.releasing(_scan(boundary, percent, keep)), "u long, v long")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def _short_pairs(lists: DataFrame, classes: DataFrame, boundary: int, percent: int) -> DataFrame:
    pairs = (
        lists.select("token", "uid", "n")
        .repartition("token")
        .sortWithinPartitions("token")
        .mapInArrow(words.releasing(_scan_short(boundary, percent)), "u long, v long")
        .distinct()
    )
    one = classes.select(F.col("uid").alias("u"), "n", F.col("signature").alias("x"))
    two = classes.select(
        F.col("uid").alias("v"), F.col("n").alias("m"), F.col("signature").alias("y")
    )
    return pairs.join(one, "u").join(two, "v").mapInArrow(words.releasing(_near(percent)), "u long, v long")


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar, by the sets themselves."""
    both = (
        pairs.join(sets.select(F.col("uid").alias("u"), F.col("members").alias("x")), "u")
        .join(sets.select(F.col("uid").alias("v"), F.col("members").alias("y")), "v")
        .withColumn("shared", F.size(F.array_intersect("x", "y")))
        .withColumn("all", F.size("x") + F.size("y") - F.col("shared"))
    )
    return both.where(F.col("shared") * 100 >= F.col("all") * percent).select("u", "v")


def _of(pairs: DataFrame, parts: DataFrame, end: str) -> DataFrame:
    """Adds ``part_u`` or ``part_v``: the component of that end, itself if it has none."""
    known = parts.select(F.col("node").alias(end), F.col("component").alias("known"))
    joined = pairs.hint("merge").join(known.hint("merge"), end, "left")
    return joined.withColumn(f"part_{end}", F.coalesce("known", end)).drop("known")


def _joined(
    pairs: DataFrame, parts: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str
) -> DataFrame:
    """Components after the links among ``pairs``, which are checked only where they matter.

    First one pair per set is checked, that with its smallest partner; of the
    others those whose ends are still apart then.
    """
    tree = scratch.write(pairs.groupBy("v").agg(F.min("u").alias("u")), f"{name}_tree")
    asked = tree.select("u", "v")
    for step in ("near", "far"):
        if asked.isEmpty():
            break
        stars = parts.select(F.col("node").alias("u"), F.col("component").alias("v"))
        links = stars.union(_checked(asked, sets, percent))
        parts = scratch.write(components(links, scratch, f"{name}_{step}"), f"{name}_{step}_parts")
        if step == "near":
            apart = _of(_of(pairs, parts, "u"), parts, "v").where("part_u <> part_v")
            apart = apart.select("u", "v").join(tree, ["u", "v"], "left_anti")
            asked = scratch.write(apart, f"{name}_apart")
    return parts


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Groups of documents linked by shingle sets with a Jaccard measure of ``percent`` or more.

    Returns one row per input row: ``id_col``, ``n_shingles`` (size of the set)
    and ``component_id`` (smallest id reachable by links, itself included).

    Null and empty texts, and texts of blanks, have no shingles and link with
    nothing; their component is their own id. Repeated rows and equal texts are
    linked; rows that share an id but not a text are not. A row with a null id
    links with nothing and has a null component. Other columns are ignored, an
    empty table gives no rows, and texts of any length are used whole.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100")
    scratch = Scratch(docs.sparkSession, "jaccard")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.mapInArrow(
        words.releasing(_sets(k, percent)), f"id {kind}, n long, key binary, head array<long>, signature binary"
    )
    rows = scratch.write(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")
    linked = rows.where("n > 0 AND id IS NOT NULL")
    first = linked.groupBy("key").agg(F.min(F.struct("id", "uid")).alias("first"))
    reps = scratch.write(first.select("key", "first.id", "first.uid"), "reps")
    # The copies are the smaller part, so that sets are rarely shuffled to leave them out.
    kept = reps.select("key", F.col("uid").alias("kept"))
    copies = linked.select("key", "uid").hint("merge").join(kept.hint("merge"), "key")
    copies = scratch.write(copies.where("uid <> kept").select("uid"), "copies")
    classes = linked.select("uid", "n", "head", "signature")
    classes = scratch.write(classes.join(copies, "uid", "left_anti"), "classes")

    lists = _lists(classes, reps, texts, k, percent, scratch)
    boundary = _boundary(classes, lists, percent)
    light = _light_links(classes, reps, texts, k, boundary, percent)
    every = scratch.write(components(light, scratch, "light"), "light")
    # Smaller sets meet none above the boundary.
    heavy = lists.where(F.col("n") * 100 >= percent * (boundary + 1))
    full = heavy.where(f"length > {SHORT}").join(classes.select("uid", "signature"), "uid")
    full = scratch.write(full.withColumn("step", _size_step(percent).cast("long")), "full")

    short = heavy.where(f"length <= {SHORT}")
    pairs = _long_pairs(_within(full), boundary, percent, "each").union(
        _short_pairs(short, classes, boundary, percent)
    )
    pairs = scratch.write(pairs.distinct(), "pairs")
    wanted = full.select("uid").union(pairs.select("u")).union(pairs.select("v")).distinct()
    sets = _fetch(texts, reps.join(wanted, "uid", "left_semi"), k)
    sets = scratch.write(sets.dropDuplicates(["uid"]), "sets")
    every = _joined(pairs, every, sets, percent, scratch, "within")
    for keep in ("component", "all"):
        split = scratch.write(_split(full, every), f"split_{keep}")
        if split.isEmpty():
            break
        pairs = scratch.write(_long_pairs(_across(split), boundary, percent, keep), f"pairs_{keep}")
        every = _joined(pairs, every, sets, percent, scratch, keep)

    of_class = reps.join(every.withColumnRenamed("node", "uid"), "uid", "left")
    of_class = of_class.select("key", "id", F.coalesce("component", "uid").alias("component"))
    of_class = scratch.write(of_class, "of_class")
    smallest = of_class.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = join_group_rows(of_class, smallest, "component").select("key", "component_id")
    members = rows.select("key", F.col("id").alias(id_col), F.col("n").alias("n_shingles"))
    own = F.when(F.col("n_shingles") == 0, F.col(id_col)).when(
        F.col(id_col).isNotNull(), F.col("component_id")
    )
    return (
        members.hint("merge")
        .join(of_class.hint("merge"), "key", "left")
        .select(id_col, "n_shingles", own.alias("component_id"))
    )


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
           THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                               FOR i IN range(1, len(w) - 1)])
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM texts),
members AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT u, v FROM pairs JOIN sets a ON a.doc_id = u JOIN sets b ON b.doc_id = v
  WHERE 100 * shared >= 90 * (len(a.s) + len(b.s) - shared)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, b.v FROM reached r JOIN both_ways b ON r.other = b.u)
SELECT doc_id, CAST(len(any_value(s)) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id
"""
