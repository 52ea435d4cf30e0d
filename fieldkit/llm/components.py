"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.session import settle


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a task's edges and the smallest node each is joined to, without the roots."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, shorter := new[new]):
            new = shorter
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _state(edges: DataFrame) -> tuple:
    """A number of edges and a sum over them that differ whenever the edges do."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return row.n, row.h


def component_roots(edges: DataFrame) -> DataFrame:
    """``a, b`` with the smallest node ``b`` joined to every node ``a`` that is not it itself.

    ``edges`` has bigint columns ``a, b``; nulls, loops and repeated edges do not matter, and no
    edges give no rows. Each round joins every node's larger neighbours to its smallest one, then
    its smaller ones, which shortens all paths until only stars are left; rounds grow with the
    logarithm of the longest path. Minima are combined before the shuffle and written out before
    they are joined, so a node with very many edges is split like any skewed join.
    """
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "lowest")
        large = settle(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
                       .join(lowest.withColumnRenamed("a", "u"), "u")
                       .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        lowest = settle(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = (large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").unionByName(lowest.select("a", F.col("m").alias("b"))))
        edges = settle(small.distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges
