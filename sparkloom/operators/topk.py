"""Top-k rows, alone and compared with their group or with everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MS_PER_MINUTE = 60_000


def top_k(df: DataFrame, order: Sequence[Column], k: int, tie: Sequence[str]) -> DataFrame:
    """The first ``k`` rows by ``order``; equal rows are settled by the ``tie`` columns.

    Spark runs this as a top-k per task and a merge of those, not as a sort.
    """
    return df.orderBy(*order, *[F.asc(name) for name in tie]).limit(k)


def _longest(
    df: DataFrame,
    by: str,
    score: str,
    rank_by: str,
    feature: str,
    min_feature: float,
    k: int,
    keep: Sequence[str],
) -> DataFrame:
    names = list(dict.fromkeys([*keep, by, rank_by, feature, score]))
    candidates = df.filter(F.col(feature) > F.lit(min_feature))
    for name in (by, score, rank_by):
        candidates = candidates.filter(F.col(name).isNotNull())
    return top_k(candidates.select(*names), [F.desc(rank_by)], k, [n for n in names if n != rank_by])


def top_vs_group(
    df: DataFrame,
    *,
    by: str,
    score: str,
    rank_by: str,
    feature: str,
    min_feature: float = 0.8,
    k: int = 10,
    unit: float = MS_PER_MINUTE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` rows with the largest ``rank_by`` among those whose ``feature`` is above
    ``min_feature``, each with its group's averages over all rows.

    Output: ``keep``, group, ``<rank_by>_units`` (``rank_by / unit``), feature,
    score, ``group_avg_score``, ``group_avg_units`` and ``score_vs_group``. The
    ``k`` rows are the small side of the join to the grouped averages.
    """
    top = _longest(df, by, score, rank_by, feature, min_feature, k, keep)
    groups = df.groupBy(by).agg(
        F.avg(score).alias("group_avg_score"),
        (F.avg(rank_by) / F.lit(unit)).alias("group_avg_units"),
    )
    return groups.join(top, by).select(
        *keep,
        by,
        (F.col(rank_by) / F.lit(unit)).alias(f"{rank_by}_units"),
        feature,
        F.col(score).cast("double").alias(score),
        "group_avg_score",
        "group_avg_units",
        (F.col(score) - F.col("group_avg_score")).alias("score_vs_group"),
    )


def top_vs_all(
    df: DataFrame,
    *,
    by: str,
    score: str,
    rank_by: str,
    feature: str,
    min_feature: float = 0.8,
    k: int = 10,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row: average score of the ``k`` rows, of all rows above ``min_feature``, and the gap.

    Missing averages count as zero, and so does the gap when either is missing.
    """
    top = _longest(df, by, score, rank_by, feature, min_feature, k, keep)
    everything = df.filter(F.col(feature) > F.lit(min_feature))
    tagged = top.select(F.col(score), F.lit(True).alias("top")).unionByName(
        everything.select(F.col(score), F.lit(False).alias("top"))
    )
    averages = tagged.agg(
        F.avg(F.when(F.col("top"), F.col(score))).alias("top_avg"),
        F.avg(F.when(~F.col("top"), F.col(score))).alias("all_avg"),
    )
    zero = F.lit(0.0)
    return averages.select(
        F.coalesce("top_avg", zero).alias("top_avg_score"),
        F.coalesce("all_avg", zero).alias("all_avg_score"),
        F.coalesce(F.col("top_avg") - F.col("all_avg"), zero).alias("impact"),
    )
