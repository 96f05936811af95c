"""Joins along checked edges.

Which side is broadcast is left to Catalyst and AQE: they know the sizes. What
can be summed before a join is summed first, so that a hot key is one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeproof.operators.keys import Edge

# A key is hot when it holds more than one thousandth of the rows; there can be at most a thousand such keys.
HOT_SHARE = 1000


def follow(child: DataFrame, parent: DataFrame, edge: Edge, keep: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join the parent along an edge and take some of its columns under new names.

    ``keep`` maps parent column to output name, so one dimension can be joined
    several times, once per role.
    """
    _, fk, _, pk = edge
    keys = [F.col(c).alias(f"_pk{i}") for i, c in enumerate(pk)]
    side = parent.select(*keys, *[F.col(c).alias(n) for c, n in keep.items()])
    on = [child[c] == side[f"_pk{i}"] for i, c in enumerate(fk)]
    return child.join(side, on, how).drop(*[f"_pk{i}" for i in range(len(pk))])


def subtotals(fact: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    """(keys…, n, total): the fact summed per key combination before any join."""
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"))


def combined(joined: DataFrame, by: Sequence[str]) -> DataFrame:
    """Subtotals added up under coarser keys, ready for the next, smaller join."""
    return joined.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def totals(joined: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts and exact sums per group from subtotals, in group order."""
    return (
        joined.groupBy(*by)
        .agg(F.sum("n").alias("n"), F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(38,4)").alias("total"))
        .orderBy(*by)
    )


def lookup(left: DataFrame, right: DataFrame, key: str, rows: int, hot_share: int = HOT_SHARE) -> DataFrame:
    """Inner join of ``left`` with a side that has each key at most once.

    ``rows`` is the size of ``left``. The rows of hot keys never go through a
    shuffle: their few partners are broadcast, fewer than ``hot_share`` by the
    definition of hot, whatever the size of the tables. All other keys join as usual.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    is_hot = F.col(key).isin([r[0] for r in counts.where(F.col("n") * hot_share > rows).select(key).collect()])
    spread = left.where(is_hot).join(F.broadcast(right.where(is_hot)), key)
    return spread.unionByName(left.where(~is_hot).join(right.where(~is_hot), key))
