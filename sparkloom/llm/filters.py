"""A bitmap of hashes, of fixed size, that tells which rows cannot match a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # 1 MB, whatever the input; a full map keeps all rows and loses none


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """The map of the long column ``hash``; at most ``bits / 64`` numbers reach the driver."""
    place = F.pmod("hash", F.lit(bits))
    word = F.floor(place / 64).cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, cast(pmod(hash, {bits}) % 64 as int))")
    rows = hashes.where("hash IS NOT NULL").groupBy(word).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(bits // 64, np.int64)
    if rows:
        out[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    return out.view(np.uint64)


def hits(marked: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are marked."""
    place = hashes.astype(np.int64) % (len(marked) * 64)
    return (marked[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1) == 1
