"""Joining detail rows to one-row-per-group results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_group_rows(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``groups`` (at most one row per ``key``) so that a hot key can be split.

    ``groups`` usually comes straight from a group-by on ``key``. Spark then
    reuses that partitioning for the join, and adaptive execution cannot split
    a skewed partition, because it only does so between two plain shuffles.
    Joining on the key and a hash of it keeps the matches and gives each side
    a shuffle of its own; the extra one moves only the grouped rows. When
    ``groups`` turns out small, Spark broadcasts it under its own size check
    and neither shuffle happens.
    """
    marked = F.xxhash64(F.col(key))
    joined = rows.withColumn("_key_hash", marked).join(
        groups.withColumn("_key_hash", marked), [key, "_key_hash"], how
    )
    return joined.drop("_key_hash")
