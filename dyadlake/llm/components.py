"""Distributed union-find over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dyadlake.operators.graph import connected_components


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root) for every node that has an edge; the root is the component's smallest node.  Reads one stored table."""
    return connected_components(edges, src, dst, "root")
