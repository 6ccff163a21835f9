"""Rows credited to several members at once, compared with the members' solo rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_multi, member_list
from .topk import top_k


def top_groups(
    df: DataFrame, *, members: str, score: str, sep: str = ";", k: int = 10
) -> DataFrame:
    """The ``k`` most frequent member combinations with their rows and average score.

    A combination is the exact text, so the order of names matters. Equal
    counts go by that text.
    """
    groups = (
        df.filter(is_multi(members, sep))
        .groupBy(members)
        .agg(F.count(F.lit(1)).alias("group_count"), F.avg(score).alias("avg_score"))
    )
    return top_k(groups, [F.desc("group_count")], k, [members])


def solo_avg(df: DataFrame, *, members: str, score: str, sep: str = ";") -> DataFrame:
    """Average score of each member's solo rows."""
    return (
        df.filter(~is_multi(members, sep))
        .groupBy(F.col(members).alias("member"))
        .agg(F.avg(score).alias("solo_avg"))
    )


def boost(df: DataFrame, *, members: str, score: str, sep: str = ";", k: int = 10) -> DataFrame:
    """:func:`top_groups` with each group's weakest member and the gain over that member.

    The weakest member has the lowest solo average, the first listed on a tie;
    members without solo rows do not count. ``boost`` is the group's average
    minus that solo average, null when no member has solo rows or the group no
    average. Solo averages are only computed for members of the ``k`` groups.
    """
    top = top_groups(df, members=members, score=score, sep=sep, k=k)
    listed = top.filter(F.col("avg_score").isNotNull()).select(
        members, F.posexplode(member_list(members, sep)).alias("pos", "member")
    )
    wanted = listed.select(F.col("member").alias(members)).distinct()
    solo = solo_avg(
        df.join(wanted, members, "left_semi"), members=members, score=score, sep=sep
    ).filter(F.col("solo_avg").isNotNull())
    weakest = (
        listed.join(solo, "member")
        .groupBy(members)
        .agg(F.min(F.struct("solo_avg", "pos", "member")).alias("weakest"))
    )
    return top.join(weakest, members, "left").select(
        members,
        "group_count",
        "avg_score",
        F.col("weakest.member").alias("weakest_member"),
        F.col("weakest.solo_avg").alias("weakest_avg"),
        (F.col("avg_score") - F.col("weakest.solo_avg")).alias("boost"),
    )


def summary(df: DataFrame, *, members: str, score: str, sep: str = ";", k: int = 10) -> DataFrame:
    """One row: rows with several members, mean boost of the ``k`` groups, whether it is a gain.

    Groups without a boost are left out of the mean; with none at all it is zero.
    """
    rows = df.filter(is_multi(members, sep)).select(
        F.lit(1).alias("is_row"), F.lit(None).cast("double").alias("boost")
    )
    boosts = boost(df, members=members, score=score, sep=sep, k=k).select(
        F.lit(None).cast("int").alias("is_row"), "boost"
    )
    mean = F.coalesce(F.avg("boost"), F.lit(0.0))
    return rows.unionByName(boosts).agg(
        F.count("is_row").alias("collaboration_rows"),
        mean.alias("average_boost"),
        (mean > 0).alias("collaborating_helps"),
    )
