"""Labels derived from a number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts of the reports.
IMPACT_LABELS = ("Positive", "Negative", "Neutral")
PATTERN_LABELS = ("Explicit_More_Positive", "NonExplicit_More_Positive", "Neutral")
DIVERSITY_LABELS = ("Highly_Specialized", "Moderately_Diverse", "Highly_Diverse")


def impact_label(difference: Column, threshold: float = 5.0) -> Column:
    """Positive above ``+threshold``, negative below ``-threshold``, else (and for null) neutral."""
    above, below, otherwise = IMPACT_LABELS
    return (
        F.when(difference > F.lit(float(threshold)), above)
        .when(difference < F.lit(-float(threshold)), below)
        .otherwise(otherwise)
    )


def sign_label(difference: Column, labels: Sequence[str] = PATTERN_LABELS) -> Column:
    """One of three labels for a positive, a negative and a zero or null difference."""
    above, below, otherwise = labels
    return F.when(difference > 0, above).when(difference < 0, below).otherwise(otherwise)


def cut_label(
    count: Column, cuts: Sequence[int] = (2, 5), labels: Sequence[str] = DIVERSITY_LABELS
) -> Column:
    """``labels[i]`` for the first ``cuts[i]`` the count does not exceed, else the last label."""
    expr = F
    for cut, label in zip(cuts, labels):
        expr = expr.when(count <= cut, label)
    return expr.otherwise(labels[len(cuts)])
