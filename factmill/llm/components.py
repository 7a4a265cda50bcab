"""Connected components of a graph too large for one machine.

Each round every node points at its smallest neighbour, if that is smaller; edges are then
relabelled by what their ends point at, and loops and repeats go. Node ids are hashes, so a
round leaves a fraction of the nodes. The rounds' pointers are composed from the last to
the first. Each round is written to the shared folder: lineage stays short, a lost executor
costs one round at most, and nothing is collected but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.scratch import Scratch, small


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """node, label (the same for all nodes of a component) for the nodes of edges (a, b)."""
    rounds: list[tuple[DataFrame, int]] = []
    edges = scratch.table(edges.where("a <> b").select("a", "b"), f"{name}-edges-0")
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to"))
        points = scratch.table(points, f"{name}-points-{len(rounds)}")
        n = points.count()
        rounds.append((points, n))
        moved = edges.join(small(points.select(F.col("node").alias("a"), F.col("to").alias("x")), n), "a").join(small(points.select(F.col("node").alias("b"), F.col("to").alias("y")), n), "b")
        moved = moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = scratch.table(moved, f"{name}-edges-{len(rounds)}")
        scratch.drop(f"{name}-edges-{len(rounds) - 1}")
    labels = None
    for points, _ in reversed(rounds):
        if labels is None:
            labels = points.select("node", F.col("to").alias("label"))
        else:
            onto = labels.select(F.col("node").alias("to"), "label")
            labels = points.join(onto, "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return scratch.table(labels, f"{name}-labels")
