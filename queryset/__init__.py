"""Registered queries over the given tables."""

from queryset import q_cluster, q_graph, q_scoring, q_stats, q_tables, q_traffic
from queryset.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "q_cluster", "q_graph", "q_scoring", "q_stats", "q_tables", "q_traffic"]
