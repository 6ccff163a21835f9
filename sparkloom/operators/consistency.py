"""Entities with the steadiest scores, and how many categories they span."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cut_label, is_multi
from ..functions.labels import DIVERSITY_LABELS
from .topk import top_k

# Sums in another order change the last bits of a standard deviation, so equal
# spreads are compared after rounding and then settled by name.
TIE_DIGITS = 9


def _solo(df: DataFrame, entity: str, sep: str | None) -> DataFrame:
    if sep is None:
        return df.filter(F.col(entity).isNotNull())
    return df.filter(~is_multi(F.col(entity), sep))


def rank_entities(
    df: DataFrame,
    *,
    entity: str,
    score: str,
    min_rows: int = 5,
    min_avg: float = 1.0,
    k: int = 20,
    sep: str | None = ";",
) -> DataFrame:
    """The ``k`` entities with the smallest positive sample stddev of their score.

    Only entities with at least ``min_rows`` rows and an average above
    ``min_avg`` count. Rows naming several entities (joined by ``sep``) are
    left out; pass ``sep=None`` for a column that holds no such rows.
    """
    stats = (
        _solo(df, entity, sep)
        .groupBy(entity)
        .agg(
            F.stddev_samp(score).alias("score_stddev"),
            F.avg(score).alias("avg_score"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .filter(
            (F.col("row_count") >= min_rows)
            & (F.col("avg_score") > F.lit(min_avg))
            & (F.col("score_stddev") > 0)
        )
    )
    return top_k(stats, [F.asc(F.round("score_stddev", TIE_DIGITS))], k, [entity])


def diversity(
    df: DataFrame,
    *,
    entity: str,
    score: str,
    category: str,
    cuts: Sequence[int] = (2, 5),
    min_rows: int = 5,
    min_avg: float = 1.0,
    k: int = 20,
    sep: str | None = ";",
) -> DataFrame:
    """:func:`rank_entities` with each entity's categories.

    Adds the number of distinct categories, the most common one (ties to the
    first by name), its share of the entity's rows in percent and a label for
    the number. Categories are only counted for the ``k`` entities.
    """
    ranked = rank_entities(
        df, entity=entity, score=score, min_rows=min_rows, min_avg=min_avg, k=k, sep=sep
    )
    categories = (
        _solo(df, entity, sep)
        .join(ranked.select(entity), entity, "left_semi")
        .groupBy(entity, category)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(entity)
        .agg(
            F.count(category).alias("category_count"),
            F.min(F.struct((-F.col("n")).alias("rank"), F.col(category).alias("name"))).alias(
                "best"
            ),
        )
    )
    return categories.join(ranked, entity).select(
        entity,
        "score_stddev",
        "avg_score",
        "row_count",
        "category_count",
        F.col("best.name").alias("primary_category"),
        (-F.col("best.rank") * 100.0 / F.col("row_count")).alias("primary_percentage"),
        cut_label(F.col("category_count"), cuts).alias("diversity"),
    )


def diversity_summary(entities: DataFrame) -> DataFrame:
    """One row: entities per diversity label, percent specialised, whether most are.

    ``entities`` is the result of :func:`diversity`. "Most" means more than
    half, with half of an odd total rounded down.
    """
    special, moderate, diverse = DIVERSITY_LABELS
    total = F.col("specialized") + F.col("moderate") + F.col("diverse")
    return entities.agg(
        *[
            F.count_if(F.col("diversity") == label).alias(name)
            for name, label in (
                ("specialized", special),
                ("moderate", moderate),
                ("diverse", diverse),
            )
        ]
    ).select(
        "specialized",
        "moderate",
        "diverse",
        F.coalesce(F.col("specialized") * 100.0 / F.nullif(total, F.lit(0)), F.lit(0.0)).alias(
            "specialized_percentage"
        ),
        (F.col("specialized") > F.floor(total / 2)).alias("most_specialized"),
    )
