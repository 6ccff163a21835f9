"""Load or generate a graph, then any of: degrees, colouring, check, change log."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from ..scratch import Scratch
from ..sources import reports
from ..sources.graph_files import read_changes, read_graph, write_coloring, write_graph


@dataclass
class GraphRun:
    """What a run produced; parts that were not asked for stay ``None``."""

    nodes: DataFrame
    edges: DataFrame
    best_k: int | None = None
    success: bool | None = None
    metrics: dict[str, DataFrame] = field(default_factory=dict)


def run(
    spark: SparkSession,
    *,
    input_path: str | None = None,
    json_lines: bool | None = None,
    generate: int | None = None,
    max_degree: int | None = None,
    seed: int = 123,
    average: bool = False,
    coloring: bool = False,
    initial_colors: int | None = None,
    validation: bool = False,
    incremental: bool = False,
    changes_path: str | None = None,
    stepwise: bool = False,
    metrics_prefix: str | None = None,
    output_graph: str | None = None,
    output_result: str | None = None,
) -> GraphRun:
    """Run the chosen steps over one graph.

    The graph is read from ``input_path`` or generated with ``generate`` nodes
    of at most ``max_degree``. ``initial_colors`` is the number of colours the
    colouring may use. ``incremental`` applies the change log (or the
    demonstration log) to the coloured graph, at once or, with ``stepwise``,
    change by change. ``validation`` checks the colours there are, whether found
    here or read. A colouring that fails is an error once its metrics are written. ``metrics_prefix`` writes the metrics as JSON,
    ``output_graph`` the graph and ``output_result`` the colouring.
    """
    if incremental and not coloring:
        raise ValueError("incremental recolouring starts from a colouring")
    if input_path and output_graph and input_path.rstrip("/") == output_graph.rstrip("/"):
        raise ValueError("output_graph must not overwrite input_path")
    if input_path:
        nodes, edges = read_graph(spark, input_path, json_lines=json_lines)
    elif generate is not None and max_degree is not None:
        nodes, edges = graph.generate_graph(spark, generate, max_degree, seed)
    else:
        raise ValueError("give input_path, or generate and max_degree")
    scratch = Scratch(spark, "graph_job")
    nodes, edges = scratch.write(nodes, "nodes"), scratch.write(edges, "edges")
    result = GraphRun(nodes, edges)

    def record(kind: str, metrics: DataFrame, started: float) -> None:
        metrics = scratch.write(metrics, f"metrics_{kind}")
        spent = int(1000 * (time.perf_counter() - started))
        result.metrics[kind] = metrics.withColumn("executionTimeMs", F.lit(spent))
        if metrics_prefix:
            reports.write_metrics(result.metrics[kind], metrics_prefix, kind)

    if average:
        started = time.perf_counter()
        stats = graph.degree_stats(nodes, edges)
        record("degree", stats.select("node_count", "average_degree", "max_degree"), started)
    if coloring:
        started = time.perf_counter()
        blank = nodes.withColumn("color", F.lit(-1))
        done = graph.color_graph(blank, edges, k_max=initial_colors, stored=True)
        result.best_k, result.success = done.best_k, done.success
        rounds = graph.coloring_rounds(done).agg(
            F.lit(done.best_k).alias("bestK"),
            F.lit(done.success).alias("success"),
            F.lit(done.rounds).alias("iterations"),
            F.coalesce(F.sum("messages"), F.lit(0)).alias("messagesSent"),
            F.lit(done.candidate_fails).alias("candidateFails"),
            F.coalesce(F.sum("tie_conflicts"), F.lit(0)).alias("tieConflicts"),
        )
        record("coloring", rounds, started)
        if not done.success:
            raise RuntimeError(f"the graph cannot be coloured with {initial_colors} colours this way")
        result.nodes = done.colors
    if validation:
        started = time.perf_counter()
        record("validation", graph.validate(result.nodes, edges), started)
    if incremental:
        if changes_path:
            changes = read_changes(spark, changes_path)
        else:
            changes = graph.demo_changes(result.nodes, edges)
        changes = scratch.write(changes, "changes")
        if stepwise:
            result.nodes, result.edges, _ = graph.recolor_stepwise(
                result.nodes, edges, changes, result.best_k
            )
        else:
            again = graph.recolor(result.nodes, edges, changes, result.best_k)
            result.nodes, result.edges = again.nodes, again.edges
        if validation:
            started = time.perf_counter()
            record("incremental", graph.validate(result.nodes, result.edges), started)
    if output_graph:
        write_graph(result.nodes, result.edges, output_graph)
    if output_result and coloring:
        write_coloring(result.nodes, result.best_k, output_result)
    return result
