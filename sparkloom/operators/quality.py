"""Probing and cleaning a table: nulls in key columns, values out of range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

Ranges = Mapping[str, tuple[float, float]]


def unit_ranges(columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """The range 0..1 for each of the columns."""
    return {name: (0.0, 1.0) for name in columns}


def _outside(name: str, low: float, high: float) -> Column:
    return (F.col(name) < F.lit(float(low))) | (F.col(name) > F.lit(float(high)))


def _inside(ranges: Ranges) -> Column:
    tests = [F.col(n).between(F.lit(float(lo)), F.lit(float(hi))) for n, (lo, hi) in ranges.items()]
    return reduce(and_, tests, F.lit(True))


def _missing(df: DataFrame, subset: Sequence[str]) -> Column:
    """Null, or NaN in a floating-point column: what ``na.drop`` removes."""
    tests = []
    for name in subset:
        test = F.col(name).isNull()
        if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
            test = test | F.isnan(name)
        tests.append(test)
    return reduce(or_, tests, F.lit(False))


def require_rows(df: DataFrame, message: str = "the input has no rows") -> DataFrame:
    """Raise ``ValueError`` when the frame is empty, else return it."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def probe(df: DataFrame, keys: Sequence[str], ranges: Ranges) -> DataFrame:
    """One row: row count, nulls per key column, out-of-range values per ranged column.

    ``bad_range_rows`` counts the rows with at least one value out of range.
    All counts come from a single pass.
    """
    outside = {name: _outside(name, lo, hi) for name, (lo, hi) in ranges.items()}
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in keys],
        *[F.count_if(test).alias(f"outside_{name}") for name, test in outside.items()],
        F.count_if(reduce(or_, outside.values(), F.lit(False))).alias("bad_range_rows"),
    )


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Remove rows with a null (or NaN) in any of the columns."""
    return df.na.drop("any", subset=list(subset))


def filter_ranges(df: DataFrame, ranges: Ranges) -> DataFrame:
    """Keep rows whose ranged columns all lie within their bounds; a null fails."""
    return df.filter(_inside(ranges))


def clean(df: DataFrame, subset: Sequence[str], ranges: Ranges) -> DataFrame:
    """Both cleaning steps."""
    return filter_ranges(drop_null(df, subset), ranges)


def clean_report(df: DataFrame, subset: Sequence[str], ranges: Ranges) -> DataFrame:
    """One row: rows before and after cleaning and what each step removes, in one pass."""
    missing = _missing(df, subset)
    kept = ~missing & F.coalesce(_inside(ranges), F.lit(False))
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(missing).alias("removed_null"),
        F.count_if(kept).alias("rows_out"),
    )
    return counts.select(
        "rows_in",
        "removed_null",
        (F.col("rows_in") - F.col("removed_null") - F.col("rows_out")).alias("removed_range"),
        (F.col("rows_in") - F.col("rows_out")).alias("removed_total"),
        "rows_out",
    )
