"""Undirected graphs as two tables: ``nodes(id, color)`` and half-edges ``edges(src, dst)``.

A null or negative colour means "uncoloured". An undirected edge is two
half-edges; a lone half-edge is a one-sided link, which only its source knows.
"""

from .build import edges_from_shared_key, generate_graph, nodes_of, normalize_edges
from .changes import affected_nodes, apply_changes, check_changes, demo_changes
from .coloring import Coloring, color_graph, color_histogram, coloring_rounds
from .degree import degree_stats, degrees
from .recolor import Recoloring, recolor, recolor_part, recolor_stepwise
from .validate import conflict_sample, conflicts, validate
from .versions import Versions

__all__ = [
    "Coloring",
    "Recoloring",
    "Versions",
    "affected_nodes",
    "apply_changes",
    "check_changes",
    "color_graph",
    "color_histogram",
    "coloring_rounds",
    "conflict_sample",
    "conflicts",
    "degree_stats",
    "degrees",
    "demo_changes",
    "edges_from_shared_key",
    "generate_graph",
    "nodes_of",
    "normalize_edges",
    "recolor",
    "recolor_part",
    "recolor_stepwise",
    "validate",
]
