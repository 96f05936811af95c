"""Self-referencing tables: dangling parents, conflicting parents, cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeproof.operators import joins, keys
from lakeproof.session import remove, write_scratch


def conflicting_parents(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(node, parents): nodes whose rows name more than one parent."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("node"))
        .agg(F.min(parent).alias("low"), F.max(parent).alias("high"), F.count(parent).alias("named"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("low") != F.col("high")) | ((F.col("named") > 0) & (F.col("named") < F.col("rows"))))
        .select("node", "low", "high")
    )


def dangling_parents(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(parent, children): parents that are no node; NULL marks a root."""
    return keys.orphan_keys({"self": df}, ("self", (parent,), "self", (key,))).select(
        F.col("k0").alias("parent"), F.col("refs").alias("children")
    )


def cycle_starts(df: DataFrame, key: str, parent: str, hot_share: int = joins.HOT_SHARE) -> DataFrame:
    """(node): every node from which some chain of parents never ends; a node may have several.

    Each round looks up, for every edge to a parent, what that parent has
    above it. An edge to a node without parents ends there and goes; an edge to
    a node with one parent moves on to that one, whose fate it shares; an edge
    to a node with several stays. If a round drops no edge, every node left has
    a parent that is left, so all of them lead into a cycle. Where nodes have
    one parent each the steps double, so the rounds grow with the logarithm of
    the longest chain; a run of nodes that keep several parents takes a round
    for each of them.

    Edges that come to be the same are one, with the number of those they stand
    for. Each round is written to the shared scratch folder, and the one before
    it is deleted. Many nodes may share an ancestor; such hot ancestors are
    looked up without a shuffle.
    """
    spark = df.sparkSession
    named = F.col(key).isNotNull() & F.col(parent).isNotNull()
    first = df.where(named).select(F.col(key).alias("node"), F.col(parent).alias("hop"))

    def settled(edges: DataFrame) -> tuple[str, DataFrame, int, int]:
        merged = edges.groupBy("node", "hop").agg(F.count(F.lit(1)).alias("merged"))
        path = write_scratch(merged, "hops")
        state = spark.read.schema(merged.schema).parquet(path)
        distinct, every = state.agg(F.count(F.lit(1)), F.coalesce(F.sum("merged"), F.lit(0))).first()
        return path, state, distinct, every

    path, state, alive, _ = settled(first)
    while alive:
        above = state.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("hop").alias("only"))
        above = above.select(F.col("node").alias("hop"), F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("node")).alias("next"))
        moved = joins.lookup(state, above, "hop", alive, hot_share).select("node", F.col("next").alias("hop"))
        before = alive
        longer, state, alive, kept = settled(moved)
        remove(spark, path)
        path = longer
        if kept == before:
            break
    return state.select("node").distinct()
