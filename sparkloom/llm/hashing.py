"""Hash columns that SQL engines agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: Column, seed: int) -> Column:
    """52 bits of the MD5 of the key's text and a seed; a null key hashes like an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) from :func:`digest`."""
    return digest(key, seed) / F.lit(2.0**52)


def digest_sql(key: str, seed: int) -> str:
    """:func:`digest` as DuckDB SQL."""
    text = f"'{seed}:' || coalesce(CAST({key} AS VARCHAR), '')"
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"
