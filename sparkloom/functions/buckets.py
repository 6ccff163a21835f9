"""Bucketing a numeric column into labelled ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four default tempo ranges.
TEMPO_BOUNDS = (100.0, 120.0, 140.0)
TEMPO_CLOSED = (False, True, True)
TEMPO_LABELS = (
    "Slow (<100 BPM)",
    "Medium (100-120 BPM)",
    "Fast (121-140 BPM)",
    "Very Fast (>140 BPM)",
)


def by_bounds(
    col: Column | str,
    bounds: Sequence[float] = TEMPO_BOUNDS,
    labels: Sequence[str] = TEMPO_LABELS,
    closed: Sequence[bool] = TEMPO_CLOSED,
) -> Column:
    """Label of the first range whose upper bound holds the value.

    ``closed[i]`` tells whether ``bounds[i]`` itself belongs to range ``i``.
    Values above every bound, and nulls, get the last label.
    """
    if len(labels) != len(bounds) + 1 or len(closed) != len(bounds):
        raise ValueError("need one closed flag per bound and one more label than bounds")
    value = F.col(col) if isinstance(col, str) else col
    expr = F
    for bound, label, inclusive in zip(bounds, labels, closed):
        limit = F.lit(float(bound))
        expr = expr.when(value <= limit if inclusive else value < limit, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def width_labels(n: int = 10) -> list[str]:
    """``0.0-0.1`` ... ``0.9-1.0`` for ten buckets: shares of the full range."""
    digits = 1 if n == 10 else 3
    return [f"{i / n:.{digits}f}-{(i + 1) / n:.{digits}f}" for i in range(n)]


def equal_width(col: Column | str, width: float = 10, n: int = 10) -> Column:
    """Label of one of ``n`` buckets of equal ``width`` starting at zero.

    Values below zero fall in the first bucket; values past the end, and nulls,
    fall in the last.
    """
    value = F.col(col) if isinstance(col, str) else col
    index = F.greatest(F.least(F.floor(value / F.lit(width)), F.lit(n - 1)), F.lit(0))
    labels = F.array(*[F.lit(label) for label in width_labels(n)])
    return F.element_at(labels, F.when(value.isNull(), n).otherwise(index + 1).cast("int"))
