"""Items that stand out in a weak group, and how they differ from the rest of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_group_rows


def items_vs_group(
    df: DataFrame,
    *,
    by: str,
    score: str,
    item_min: float = 80,
    group_max: float = 50,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows scoring above ``item_min`` in groups that average below ``group_max``.

    Output: ``keep``, group, score and ``group_avg_score``. The group side of
    the join only holds weak groups that do have such a row.
    """
    hit = F.col(score) > F.lit(item_min)
    weak = (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.avg(score).alias("group_avg_score"), F.max(score).alias("_best"))
        .filter((F.col("group_avg_score") < F.lit(group_max)) & (F.col("_best") > F.lit(item_min)))
        .drop("_best")
    )
    names = list(dict.fromkeys([*keep, by, score]))
    hits = df.filter(hit).select(*names)
    return join_group_rows(hits, weak, by).select(*names, "group_avg_score")


def feature_gap(
    df: DataFrame,
    *,
    by: str,
    score: str,
    features: Sequence[str],
    item_min: float = 80,
    group_max: float = 50,
) -> DataFrame:
    """One row: features of the standout rows, of the other rows, and the gap.

    Averages are taken inside each weak group that has both kinds of row and
    then over the groups, each counting once. One conditional group-by gives
    both sides of every group.
    """
    hit = F.col(score) > F.lit(item_min)
    rest = F.col(score) <= F.lit(item_min)
    grouped = (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.avg(score).alias("_avg"),
            F.count_if(hit).alias("_hits"),
            F.count_if(rest).alias("_rest"),
            *[F.avg(F.when(hit, F.col(f))).alias(f"hit_{f}") for f in features],
            *[F.avg(F.when(rest, F.col(f))).alias(f"other_{f}") for f in features],
        )
        .filter((F.col("_avg") < F.lit(group_max)) & (F.col("_hits") > 0) & (F.col("_rest") > 0))
    )
    return grouped.agg(
        *[F.avg(f"hit_{f}").alias(f"hit_{f}") for f in features],
        *[F.avg(f"other_{f}").alias(f"other_{f}") for f in features],
        *[F.avg(F.col(f"hit_{f}") - F.col(f"other_{f}")).alias(f"gap_{f}") for f in features],
    )
