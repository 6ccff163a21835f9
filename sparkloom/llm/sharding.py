"""Placing keys on shards by a lookup table that shards fill in turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import digest, digest_sql

SHARDS = 64
SLOTS = 10_007  # prime, over a hundred times the shards: their shares differ by a slot
SEED = 1
STEP = 50_000  # claims tried per pass of the fill


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(
    spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS, seed: int = SEED
) -> DataFrame:
    """``slot, shard`` for every slot of the table.

    A shard's order of preference starts at an offset and goes on by a stride,
    both from hashes of its number. In turn, each shard claims the first slot in
    its order that is free. The fill is a fold over claims: its state is a byte
    string with two bytes per slot, the places the shards have reached, and whose
    turn it is. A claim of a taken slot moves the shard on; after ``STEP`` claims
    the state starts the next pass, until no slot is free.

    Adding or removing a shard moves few keys between the others. The work
    depends on ``slots`` and ``shards`` alone, never on the data.
    """
    if not _prime(slots):
        raise ValueError("the number of slots must be prime, or orders would miss slots")
    if not 0 < shards <= min(slots, 32_767):
        raise ValueError("there must be 1 to 32767 shards, and no more than slots")
    offset, stride = digest(F.col("id"), 2 * seed), digest(F.col("id"), 2 * seed + 1)
    numbers = spark.range(shards).select(
        F.col("id"),
        (offset % slots).alias("offset"),
        (stride % max(slots - 1, 1) + 1).alias("stride"),
    )
    orders = numbers.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("orders"))
    state = orders.select(
        "orders",
        F.expr(f"unhex(repeat('FFFF', {slots}))").alias("owner"),
        F.expr(f"array_repeat(0, {shards})").alias("place"),
        F.lit(0).alias("turn"),
        F.lit(0).alias("filled"),
    )
    slot = "cast((orders[s.turn].offset + s.place[s.turn] * orders[s.turn].stride) % {m} as int)"
    slot = slot.format(m=slots)
    free = f"substring(s.owner, 2 * {slot} + 1, 2) = X'FFFF'"
    claim = f"""
      aggregate(sequence(1, {STEP}),
        named_struct('owner', owner, 'place', place, 'turn', turn, 'filled', filled),
        (s, i) -> if(s.filled = {slots}, s, named_struct(
          'owner', if({free}, overlay(s.owner PLACING unhex(lpad(hex(s.turn), 4, '0'))
                                      FROM 2 * {slot} + 1), s.owner),
          'place', transform(s.place, (p, k) -> if(k = s.turn, p + 1, p)),
          'turn', if({free}, (s.turn + 1) % {shards}, s.turn),
          'filled', if({free}, s.filled + 1, s.filled))))"""
    while True:
        state = state.withColumn("s", F.expr(claim)).select(
            "orders", "s.owner", "s.place", "s.turn", "s.filled"
        )
        row = state.first()  # one row, of a size set by slots and shards
        if row["filled"] == slots:
            break
        state = orders.select(
            "orders",
            F.lit(bytes(row["owner"])).alias("owner"),
            F.array(*[F.lit(p) for p in row["place"]]).alias("place"),
            F.lit(row["turn"]).alias("turn"),
            F.lit(row["filled"]).alias("filled"),
        )
    owner = F.lit(bytes(row["owner"]))
    at = (2 * F.col("slot") + 1).cast("int")
    shard = F.conv(F.hex(F.substring(owner, at, F.lit(2))), 16, 10).cast("int")
    return spark.range(slots).select(F.col("id").alias("slot")).select("slot", shard.alias("shard"))


def slot_of(key: Column, slots: int = SLOTS, seed: int = SEED) -> Column:
    """The slot of a key; a null key has the slot of an empty one."""
    return F.pmod(digest(key, 100 + seed), F.lit(slots))


def place(
    rows: DataFrame, key: str, shards: int = SHARDS, slots: int = SLOTS, seed: int = SEED
) -> DataFrame:
    """All rows and columns, with ``slot`` and ``shard``.

    The table has ``slots`` rows whatever the data, so it is broadcast, and a key
    is placed by one lookup. Equal keys share a shard, null keys go to the shard
    of the empty key, repeated rows stay, and an empty table stays empty. Columns
    of the input called ``slot`` or ``shard`` are replaced.
    """
    own = [c for c in rows.columns if c not in ("slot", "shard")]
    found = lookup_table(rows.sparkSession, shards, slots, seed)
    return (
        rows.select(*own, slot_of(F.col(key), slots, seed).alias("slot"))
        .join(F.broadcast(found), "slot")
        .select(*own, "slot", "shard")
    )


def lookup_list(shards: int = SHARDS, slots: int = SLOTS, seed: int = SEED) -> list[int]:
    """The table by a plain loop, for checks."""
    import hashlib

    def number(key: int, seed: int) -> int:
        return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16)

    offset = [number(i, 2 * seed) % slots for i in range(shards)]
    stride = [number(i, 2 * seed + 1) % max(slots - 1, 1) + 1 for i in range(shards)]
    owner, at, filled = [-1] * slots, [0] * shards, 0
    while filled < slots:
        for i in range(shards):
            while filled < slots:
                slot = (offset[i] + at[i] * stride[i]) % slots
                at[i] += 1
                if owner[slot] < 0:
                    owner[slot], filled = i, filled + 1
                    break
    return owner


def oracle_sql(key: str = "doc_id", table: str = "documents") -> str:
    """The placing as DuckDB SQL, over the table filled by a plain loop."""
    slot = f"{digest_sql(key, 100 + SEED)} % {SLOTS}"
    return f"""
SELECT {key}, CAST({slot} AS BIGINT) AS slot,
       CAST({lookup_list()}[{slot} + 1] AS INTEGER) AS shard
FROM {table}
"""
