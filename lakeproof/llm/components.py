"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeproof.llm import frames


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, label): every node of the edges (a, b) with the least node it is connected to.

    In each round every node points to its least neighbour if that is smaller,
    and on to where that one points, twice over; nodes that point to the same
    place become one. The least node of a component points to itself, so it is
    what all end at; a chain shrinks to a fourth each round. A node with very
    many edges is one row for each task before the shuffle, or the side of a
    join that AQE splits. Every round is written to the shared folder. No edges, no rows.
    """
    left = frames.materialise(edges.where("a <> b").select("a", "b").distinct(), label)
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    out = frames.materialise(nodes.select("node", F.col("node").alias("label")), label)
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        points = both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to"))
        points = frames.materialise(points, label)
        for _ in range(2):
            ahead = points.select(F.col("a").alias("_a"), F.col("to").alias("_to"))
            points = points.join(ahead, F.col("to") == F.col("_a")).select("a", F.col("_to").alias("to"))
        points = frames.materialise(points, label)
        ends = points.select(F.col("a").alias("_a"), F.col("to").alias("_to"))
        out = frames.materialise(
            out.join(ends, out["label"] == ends["_a"], "left").select("node", F.coalesce("_to", "label").alias("label")), label
        )
        for side in ("a", "b"):
            other = "b" if side == "a" else "a"
            left = left.join(ends, left[side] == ends["_a"]).select(F.col("_to").alias(side), other)
        left = frames.materialise(left.where("a <> b").select("a", "b").distinct(), label)
    return out
