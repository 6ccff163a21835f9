"""Comparing groups of rows: a flag's effect, two cohorts, most common value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import equal_width, impact_label, sign_label


def _present(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def flag_impact(
    df: DataFrame, *, by: str, flag: str, score: str, threshold: float = 5.0
) -> DataFrame:
    """Per group: average score with and without the flag, their difference, its label.

    Only groups with rows on both sides are kept. One conditional group-by
    replaces the two filtered group-bys and the join between them.
    """
    on = F.col(flag)
    grouped = (
        _present(df, by)
        .groupBy(by)
        .agg(
            F.avg(F.when(on, F.col(score))).alias("flag_avg"),
            F.avg(F.when(~on, F.col(score))).alias("other_avg"),
            F.count_if(on).alias("_on"),
            F.count_if(~on).alias("_off"),
        )
        .filter((F.col("_on") > 0) & (F.col("_off") > 0))
    )
    difference = F.col("flag_avg") - F.col("other_avg")
    return grouped.select(
        by,
        "flag_avg",
        "other_avg",
        difference.alias("difference"),
        impact_label(difference, threshold).alias("impact"),
    )


def flag_impact_counts(impact: DataFrame) -> DataFrame:
    """One row: groups per impact label, from the result of :func:`flag_impact`."""
    return impact.agg(
        *[
            F.count_if(F.col("impact") == label).alias(f"{label.lower()}_groups")
            for label in ("Positive", "Negative", "Neutral")
        ]
    )


def flag_impact_top(impact: DataFrame, *, by: str, k: int = 10) -> DataFrame:
    """The ``k`` groups with the largest rise and the ``k`` with the largest fall.

    ``impact`` is the result of :func:`flag_impact`; equal differences go by group name.
    """
    order = Window.partitionBy("impact").orderBy(F.desc(F.abs("difference")), F.asc(by))
    return (
        impact.filter(F.col("impact") != "Neutral")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("impact", "rank", by, "difference")
    )


def flag_by_bucket(
    df: DataFrame, *, score: str, flag: str, value: str, width: float = 10, n: int = 10
) -> DataFrame:
    """Per score bucket: average value and rows with and without the flag, and which is higher."""
    on = F.col(flag)
    grouped = (
        df.withColumn("bucket", equal_width(score, width, n))
        .groupBy("bucket")
        .agg(
            F.avg(F.when(on, F.col(value))).alias("flag_avg"),
            F.avg(F.when(~on, F.col(value))).alias("other_avg"),
            F.count_if(on).alias("flag_count"),
            F.count_if(~on).alias("other_count"),
        )
    )
    difference = F.col("flag_avg") - F.col("other_avg")
    return grouped.withColumn("difference", difference).withColumn(
        "pattern", sign_label(difference)
    )


def dominant_pattern(buckets: DataFrame, n: int = 7) -> DataFrame:
    """One row: the most common pattern of :func:`flag_by_bucket` and whether ``n`` buckets share it.

    Equal counts go to the first pattern by name; without buckets the pattern is empty.
    """
    best = (
        buckets.groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.min(F.struct((-F.col("n")).alias("rank"), "pattern")).alias("best"))
    )
    found = F.coalesce(-F.col("best.rank"), F.lit(0)).cast("long")
    return best.select(
        F.coalesce("best.pattern", F.lit("")).alias("dominant_pattern"),
        found.alias("bucket_count"),
        (found >= n).alias("is_consistent"),
    )


def mode_per_group(df: DataFrame, *, by: str, value: str) -> DataFrame:
    """Per group: its most frequent value and that value's rows; ties go to the smallest value.

    The counts are reduced with ``min`` over (negated count, value), which
    combines before the shuffle, instead of ranking every group's values.
    """
    counts = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(by).agg(
        F.min(F.struct((-F.col("n")).alias("rank"), F.col(value).alias("value"))).alias("best")
    )
    return best.select(
        by,
        F.col("best.value").alias(f"mode_{value}"),
        (-F.col("best.rank")).alias("mode_count"),
    )


def _all(features: Sequence[str], test) -> Column:
    first, *rest = [test(F.col(name)) for name in features]
    for other in rest:
        first = first & other
    return first


def two_cohorts(
    df: DataFrame,
    *,
    by: str,
    features: Sequence[str],
    score: str,
    high: float = 0.8,
    low: float = 0.3,
) -> DataFrame:
    """Per cohort and group: average score, average of each feature, rows.

    Cohort ``high`` has every feature above ``high``; cohort ``low`` has every
    feature below ``low``. With ``low <= high`` no row is in both, so one scan
    and one group-by serve the two.
    """
    if low > high:
        raise ValueError("low must not exceed high")
    cohort = F.when(_all(features, lambda c: c > F.lit(high)), "high").when(
        _all(features, lambda c: c < F.lit(low)), "low"
    )
    return (
        df.withColumn("cohort", cohort)
        .filter(F.col("cohort").isNotNull())
        .groupBy("cohort", by)
        .agg(
            F.avg(score).alias("avg_score"),
            *[F.avg(name).alias(f"avg_{name}") for name in features],
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def two_cohorts_summary(groups: DataFrame, threshold: float = 5.0) -> DataFrame:
    """One row: groups per cohort, unweighted mean of their averages, the gap and its label.

    Means, gap and label are null unless both cohorts have groups.
    """
    is_high, is_low = F.col("cohort") == "high", F.col("cohort") == "low"
    both = (F.col("high_groups") > 0) & (F.col("low_groups") > 0)
    gap = F.col("high_mean") - F.col("low_mean")
    return groups.agg(
        F.count_if(is_high).alias("high_groups"),
        F.count_if(is_low).alias("low_groups"),
        F.avg(F.when(is_high, F.col("avg_score"))).alias("high_mean"),
        F.avg(F.when(is_low, F.col("avg_score"))).alias("low_mean"),
    ).select(
        "high_groups",
        F.when(both, F.col("high_mean")).alias("high_avg_score"),
        "low_groups",
        F.when(both, F.col("low_mean")).alias("low_avg_score"),
        F.when(both, gap).alias("difference"),
        F.when(both & gap.isNotNull(), impact_label(gap, threshold)).alias("impact"),
    )
