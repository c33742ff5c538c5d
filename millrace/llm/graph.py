"""Connected components, inside a task and across the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.lineage import materialize


def local_roots(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`roots` (each slot's smallest known slot) after joining the slots a[i] and b[i]."""
    while len(a):
        x, y = roots[a], roots[b]
        differ = x != y
        if not differ.any():
            return roots
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jump := roots[roots], roots):
            roots = jump
    return roots


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of an edge (a, b), the same root for all that are connected.

    Each round points every node at its smallest neighbour and contracts the edges to
    those; a round's tables are written to the shared folder, so a lost executor costs
    its own tasks only. The rounds grow with the logarithm of the longest chain.
    """
    left = materialize(edges.filter("a <> b").distinct())
    found = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lower = both.groupBy("a").agg(F.min("b").alias("b"))
        step = materialize(lower.select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        twice = step.join(step.select(F.col("node").alias("root"), F.col("root").alias("next")), "root")
        step = materialize(twice.select("node", F.col("next").alias("root")))
        as_a = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        as_b = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        left = materialize(
            left.join(as_a, "a").join(as_b, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a <> b").distinct()
        )
        if found is None:
            found = step
        else:
            after = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = materialize(found.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
    return edges.sparkSession.createDataFrame([], "node long, root long") if found is None else found
