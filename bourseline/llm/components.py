"""Connected components of a graph given as edges, by contraction.

In each round every node hooks to its smallest neighbour, edges are redrawn between the
hooked ends, and nodes without edges leave. Ids should be in random order (hashes), so
that chains of hooks are short. Each round is written to the shared folder: a lost
executor costs one round, and the plan stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseline.sources.storage import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is one of its nodes.
    Loops, repeated edges and an empty table are allowed; an edge with a null end counts for nothing."""
    edges = edges.select("a", "b").where("a != b").distinct()
    labels = None
    while True:
        edges = stage(edges, "edges")
        if edges.isEmpty():
            break
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stage(ends.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("hook")), "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("hook").alias("component"))
        else:
            known = hooks.select(F.col("node").alias("component"), "hook")
            labels = labels.join(known, "component", "left").select("node", F.coalesce("hook", "component").alias("component"))
        labels = stage(labels, "labels")
        first = hooks.select(F.col("node").alias("a"), F.col("hook").alias("x"))
        second = hooks.select(F.col("node").alias("b"), F.col("hook").alias("y"))
        edges = (
            edges.join(first, "a").join(second, "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .where("a != b").distinct()
        )
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
