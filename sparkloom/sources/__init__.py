"""Readers and writers."""

from .graph_files import read_changes, read_graph, write_coloring, write_graph
from .reports import run_metrics, write_metrics, write_result
from .tables import TRACK_SCHEMA, parse_csv, read_csv, read_tracks

__all__ = [
    "TRACK_SCHEMA",
    "parse_csv",
    "read_changes",
    "read_csv",
    "read_graph",
    "read_tracks",
    "run_metrics",
    "write_coloring",
    "write_graph",
    "write_metrics",
    "write_result",
]
