"""In which range of ``x`` the best groups score best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import by_bounds
from .topk import top_k


def _top_groups(
    df: DataFrame, by: str, score: str, x: str, bucket: Column | None, top: int
) -> DataFrame:
    """The ``top`` groups by average score, each with an array of its buckets.

    Rows are reduced to one per group and bucket, then to one per group that
    nests its few buckets, so ranking the groups needs neither a second scan
    nor a join.
    """
    buckets = (
        df.withColumn("bucket", by_bounds(x) if bucket is None else bucket)
        .groupBy(by, "bucket")
        .agg(
            F.sum(F.col(score).cast("double")).alias("score_sum"),
            F.count(score).alias("score_count"),
            F.avg(x).alias("avg_x"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )
    groups = buckets.groupBy(by).agg(
        (F.sum("score_sum") / F.nullif(F.sum("score_count"), F.lit(0))).alias("group_avg_score"),
        F.collect_list(
            F.struct(
                "bucket",
                (F.col("score_sum") / F.nullif(F.col("score_count"), F.lit(0))).alias("avg_score"),
                "avg_x",
                "row_count",
            )
        ).alias("buckets"),
    )
    return top_k(groups, [F.desc_nulls_last("group_avg_score")], top, [by])


def bucket_stats(
    df: DataFrame, *, by: str, score: str, x: str, bucket: Column | None = None, top: int = 5
) -> DataFrame:
    """For the ``top`` groups by average score: average score, average ``x`` and rows per bucket.

    ``bucket`` is a label expression, by default the four tempo ranges over ``x``.
    """
    return _top_groups(df, by, score, x, bucket, top).select(
        by, "group_avg_score", F.inline("buckets")
    )


def best_bucket(
    df: DataFrame, *, by: str, score: str, x: str, bucket: Column | None = None, top: int = 5
) -> DataFrame:
    """For the ``top`` groups: the best bucket and its lead over the worst one.

    Equal averages go by bucket label. The lead is null when there is only one bucket.
    """
    scored = F.filter("buckets", lambda b: b["avg_score"].isNotNull())
    ranked = F.array_sort(
        F.transform(
            scored,
            lambda b: F.struct((-b["avg_score"]).alias("rank"), b["bucket"].alias("bucket")),
        )
    )
    top_rows = _top_groups(df, by, score, x, bucket, top).select(
        by, "group_avg_score", F.size("buckets").alias("n"), ranked.alias("ranked")
    )
    best, worst = F.get("ranked", F.lit(0)), F.get("ranked", F.size("ranked") - 1)
    return top_rows.select(
        by,
        "group_avg_score",
        best["bucket"].alias("best_bucket"),
        (-best["rank"]).alias("best_avg_score"),
        F.when(F.col("n") > 1, worst["rank"] - best["rank"]).alias("advantage"),
    )


def summary(best: DataFrame, threshold: float = 5.0) -> DataFrame:
    """One row: groups, mean advantage (zero without any), whether it exceeds ``threshold``.

    ``best`` is the result of :func:`best_bucket`.
    """
    mean = F.coalesce(F.avg("advantage"), F.lit(0.0))
    return best.agg(
        F.count(F.lit(1)).alias("group_count"),
        mean.alias("average_advantage"),
        (mean > F.lit(threshold)).alias("is_significant"),
    )
