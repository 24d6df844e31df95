"""The report on a run: discovery, files, topics, consumers and graph as one dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from treeloom.operators import discovery, graph, reports


def dataset(
    listing: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    metadata: DataFrame,
    log: DataFrame,
    lag: DataFrame,
    vertices: DataFrame,
    relations: DataFrame,
) -> dict[str, DataFrame]:
    """The parts of the report by name; each stays a table, whatever its size."""
    return {
        "totals": discovery.totals(listing),
        "top_dirs": discovery.top_dirs(listing),
        "largest": discovery.largest(listing),
        "files": reports.batch_table(metadata),
        "edges_per_file": reports.edge_counts(edges),
        "samples": reports.samples(nodes, edges),
        "topics": reports.topic_counts(log),
        "lag": lag,
        "graph": graph.graph_totals(vertices),
        "relationships": graph.relationship_counts(relations),
        "types": graph.type_histogram(vertices, with_null=True),
    }


def write(parts: dict[str, DataFrame], path: str) -> None:
    """The parts as JSON below ``path``, a folder each."""
    reports.write_report(parts, path)
