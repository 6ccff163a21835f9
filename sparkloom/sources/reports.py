"""Writing results, metrics and run times."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes of the metric files.
METRIC_SUFFIXES = {
    "degree": "_avg_degree",
    "coloring": "_coloring_optimized",
    "validation": "_validation",
    "incremental": "_incremental_validation",
}


def write_metrics(metrics: DataFrame, prefix: str, kind: str) -> str:
    """Write one-row ``metrics`` as JSON to ``<prefix><suffix>.json``; returns the path."""
    path = f"{prefix}{METRIC_SUFFIXES[kind]}.json"
    metrics.write.mode("overwrite").json(path)
    return path


def write_result(
    folder: str, name: str, description: str, parts: Mapping[str, DataFrame]
) -> None:
    """Write an analysis as JSON: one sub-folder per part plus ``about``.

    Parts stay tables, one JSON record per row, so a long one is written by
    many tasks. NaN and infinities are written as strings.
    """
    for part, rows in parts.items():
        rows.write.mode("overwrite").json(f"{folder}/{name}/{part}")
    spark = next(iter(parts.values())).sparkSession
    spark.range(1).select(
        F.lit(name).alias("analysis_name"),
        F.lit(description).alias("description"),
        F.current_timestamp().alias("timestamp"),
    ).write.mode("overwrite").json(f"{folder}/{name}/about")


def read_result(spark: SparkSession, folder: str, name: str, part: str, schema: str) -> DataFrame:
    """A part that :func:`write_result` has written, NaN and infinities included."""
    return spark.read.schema(schema).json(f"{folder}/{name}/{part}")


def run_metrics(
    spark: SparkSession, timings: Sequence[tuple[str, float]], total_ms: float
) -> DataFrame:
    """``(step, name, ms, pct)``: each analysis, their sum, their mean and the whole run.

    ``pct`` is the share of ``total_ms``.
    """
    spent = sum(ms for _, ms in timings)
    lines = [(i, name, float(ms)) for i, (name, ms) in enumerate(timings, 1)]
    lines += [
        (None, "all analyses", float(spent)),
        (None, "mean per analysis", float(spent) / max(1, len(timings))),
        (None, "whole run", float(total_ms)),
    ]
    rows = [(step, name, ms, 100.0 * ms / total_ms if total_ms else None) for step, name, ms in lines]
    return spark.createDataFrame(rows, "step int, name string, ms double, pct double")
