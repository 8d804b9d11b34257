"""Connected components of a graph given as edges, by contraction: no step holds the graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id in edges (a long, b long); component is the smallest id that links reach.

    Each round lets every node point at its smallest neighbour, follows the pointers twice, and contracts the edges to
    what is left between different pointers; the edges at least halve. The minimum is aggregated before the shuffle, so a
    node with very many edges costs each map task one row. Null ends are dropped; no edges give an empty result. If `rounds`
    rounds (enough for any number of edges that a table can have) leave edges, that is an error."""
    edges = materialize(edges.filter("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("p"))
        near = materialize(near, "pointers")
        for _ in range(2):
            up = near.select(F.col("id").alias("p"), F.col("p").alias("pp"))
            near = near.join(up, "p", "left").select("id", F.coalesce("pp", "p").alias("p"))
        near = materialize(near, "pointers")
        moved = near.select(F.col("id").alias("component"), F.col("p").alias("to"))
        labels = near.select("id", F.col("p").alias("component")) if labels is None else labels.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        labels = materialize(labels, "labels")
        ends = edges.join(near.select(F.col("id").alias("a"), F.col("p").alias("pa")), "a").join(near.select(F.col("id").alias("b"), F.col("p").alias("pb")), "b")
        edges = materialize(ends.filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
    raise RuntimeError(f"components are not complete after {rounds} rounds")
