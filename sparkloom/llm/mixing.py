"""Mixing sources to target weights by repeating or dropping whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .hashing import digest_sql, unit

SEED = 4
MOST = 3  # a source is repeated so many times at most
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """``source, source_size, target`` per source.

    Sources in order of code points, null last, take the weights in turn. All
    targets together are the whole size. A target stops at ``most`` times its
    source's size, and the others share the rest by weight: with the sources in
    order of the share at which they stop, the common share per weight is the
    largest of those that follow from stopping the first 0, 1, 2, ... of them.
    The windows run over one row per source.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1))
    limit = (F.lit(most) * F.col("source_size")).cast("double")
    by_stop = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.sum("limit").over(by_stop.rowsBetween(Window.unboundedPreceding, -1))
    open_weight = F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    whole = F.sum("source_size").over(everything)
    share = (whole - F.coalesce(stopped, F.lit(0.0))) / open_weight
    return (
        totals.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("share", share)
        .withColumn("share", F.max("share").over(everything))
        .select(
            "source", "source_size",
            F.least("limit", F.col("share") * F.col("weight")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """How often each document is in the mix.

    Returns one row per input row: the id and source columns, ``size`` (words),
    ``source_size``, ``target``, ``copies`` and ``taken`` (words). A source's
    repetition rate is its target over its size; a document is taken the whole
    part of the rate times, and once more if its hash, by id and seed, is below
    the fraction. So reruns agree, and repeated rows are decided alike.

    Null and empty texts have size 0 and count as documents; a source without
    words has target and copies 0. Null ids hash like empty ones. An empty table
    gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("of"),
        word_count(F.col(text_col)).alias("size"),
    )
    sizes = scratch.write(sizes, "sizes")
    targets = scratch.write(source_targets(sizes, "of", "size", weights, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = (unit(F.col("id"), seed) < F.col("rate") - F.floor("rate")).cast("long")
    return (
        sizes.join(targets, F.col("of").eqNullSafe(F.col("source")))
        .withColumn("rate", rate)
        .withColumn("copies", F.floor("rate") + extra)
        .select(
            F.col("id").alias(id_col), F.col("of").alias(source_col), "size", "source_size",
            "target", "copies", (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """The documents of the mix with all their columns, one row per copy, by :func:`mix`.

    The targets come from one pass; the copies are made where a document is read,
    without a shuffle, as the table of sources is small enough to be sent along.
    """
    own = docs.columns
    sizes = docs.select(F.col(source_col).alias("of"), word_count(F.col(text_col)).alias("size"))
    targets = source_targets(sizes, "of", "size", weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(F.struct("source", rate.alias("rate")).alias("_mix"))
    targets = Scratch(docs.sparkSession, "mixed").write(targets, "targets")
    part = F.col("_mix.rate") - F.floor("_mix.rate")
    copies = F.floor("_mix.rate") + (unit(F.col(id_col), seed) < part).cast("long")
    return (
        docs.join(targets, F.col(source_col).eqNullSafe(F.col("_mix.source")))
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(*own)
    )


ORACLE_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         CAST({MOST} * source_size AS DOUBLE) AS cap
  FROM totals),
shares AS (
  SELECT *, ((SELECT sum(source_size) FROM totals) - coalesce(sum(cap) OVER (
           ORDER BY cap / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) / sum(weight) OVER (
           ORDER BY cap / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
targets AS (
  SELECT source, source_size, least(cap, (SELECT max(share) FROM shares) * weight) AS target
  FROM shares),
rates AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         {digest_sql("s.doc_id", SEED)} / 4503599627370496.0::DOUBLE AS u
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT)
         AS taken
FROM rates
"""
