"""Key uniqueness and referential checks.

Every test is one aggregation by key over only the key columns. Rows are
combined before the shuffle, so a key that holds a third of all rows travels as
one row per task, and nothing is joined row by row. Tests whose keys have the
same types share one aggregation, each under its own number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeproof.functions.sqltext import name
from lakeproof.operators.profile import union_all
from lakeproof.session import local_frame

Edge = tuple[str, tuple[str, ...], str, tuple[str, ...]]  # child, columns, parent, columns


def spell(table: str, columns: Sequence[str]) -> str:
    return f"{table}.{'+'.join(columns)}"


def spell_edge(edge: Edge) -> str:
    child, columns, parent, targets = edge
    return f"{spell(child, columns)} -> {spell(parent, targets)}"


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def _names(n: int) -> list[str]:
    return [f"k{i}" for i in range(n)]


def _shared_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type two key columns are compared in."""
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    return a if a == b else T.StringType()


def _as_keys(columns: Sequence[str], types: Sequence[T.DataType]) -> list[str]:
    return [f"CAST({name(c)} AS {t.simpleString()}) AS k{i}" for i, (c, t) in enumerate(zip(columns, types))]


def _by_shape(shapes: Sequence[tuple[T.DataType, ...]]) -> list[list[int]]:
    groups: dict[tuple, list[int]] = {}
    for i, shape in enumerate(shapes):
        groups.setdefault(tuple(t.simpleString() for t in shape), []).append(i)
    return list(groups.values())


def key_audit(frames: Mapping[str, DataFrame], candidates: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """(table_name, key_name, rows, surplus, null_rows) per candidate key.

    ``surplus`` is rows minus distinct keys, NULL counting as a value.
    """
    shapes = []
    for table, key in candidates:
        own = [frames[table].schema[c].dataType for c in key]
        shapes.append(tuple(_shared_type(t, t) for t in own))
    found = []
    for group in _by_shape(shapes):
        names = _names(len(shapes[group[0]]))
        rows = union_all(
            frames[candidates[i][0]].selectExpr(f"{i} AS test", *_as_keys(candidates[i][1], shapes[i])) for i in group
        )
        per_key = rows.groupBy("test", *names).agg(F.count(F.lit(1)).alias("n"))
        found.append(
            per_key.groupBy("test").agg(
                F.sum("n").alias("rows"),
                F.sum(F.col("n") - 1).alias("surplus"),
                F.sum(F.when(~all_present(names), F.col("n"))).alias("null_rows"),
            )
        )
    tests = [(i, t, "+".join(k)) for i, (t, k) in enumerate(candidates)]
    return _every_test(frames, tests, "test int, table_name string, key_name string", found, ("rows", "surplus", "null_rows"))


def _every_test(
    frames: Mapping[str, DataFrame], tests: list[tuple], ddl: str, found: list[DataFrame], counts: Sequence[str]
) -> DataFrame:
    """One row per test, also for the ones whose tables are empty."""
    spark = next(iter(frames.values())).sparkSession
    listed = local_frame(spark, tests, ddl)
    names = [c for c in listed.columns if c != "test"]
    return listed.join(union_all(found), "test", "left").select(
        *names, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts]
    )


def duplicate_examples(df: DataFrame, key: Sequence[str], n: int = 3) -> DataFrame:
    """The first repeated keys in key order, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").orderBy(*key).limit(n)


def _edge_shape(frames: Mapping[str, DataFrame], edge: Edge) -> tuple[T.DataType, ...]:
    child, fk, parent, pk = edge
    return tuple(
        _shared_type(frames[child].schema[c].dataType, frames[parent].schema[p].dataType) for c, p in zip(fk, pk)
    )


def _key_counts(frames: Mapping[str, DataFrame], edges: Mapping[int, Edge], shape: Sequence[T.DataType]) -> DataFrame:
    """(test, keys…, refs, targets): per key, the child rows and the parent rows."""
    sides = []
    for i, (child, fk, parent, pk) in edges.items():
        for table, columns, refs in ((child, fk, 1), (parent, pk, 0)):
            keys = _as_keys(columns, shape)
            sides.append(frames[table].selectExpr(f"{i} AS test", *keys, f"{refs} AS ref", f"{1 - refs} AS target"))
    return (
        union_all(sides)
        .groupBy("test", *_names(len(shape)))
        .agg(F.sum("ref").alias("refs"), F.sum("target").alias("targets"))
    )


def edge_audit(frames: Mapping[str, DataFrame], edges: Sequence[Edge]) -> DataFrame:
    """(edge, compared, orphan_keys, orphan_rows, target_surplus) per edge.

    Child and parent keys meet in one aggregation. It finds the orphans, counts
    what was compared, and shows whether the target is unique, NULL counting as
    a value there. A child key with any NULL part refers to nothing.
    """
    shapes = [_edge_shape(frames, e) for e in edges]
    found = []
    for group in _by_shape(shapes):
        shape = shapes[group[0]]
        per_key = _key_counts(frames, {i: edges[i] for i in group}, shape)
        whole = all_present(_names(len(shape)))
        orphan = whole & (F.col("refs") > 0) & (F.col("targets") == 0)
        found.append(
            per_key.groupBy("test").agg(
                F.sum(F.when(whole, F.col("refs"))).alias("compared"),
                F.count_if(orphan).alias("orphan_keys"),
                F.sum(F.when(orphan, F.col("refs"))).alias("orphan_rows"),
                F.sum(F.when(F.col("targets") > 1, F.col("targets") - 1)).alias("target_surplus"),
            )
        )
    tests = [(i, spell_edge(e)) for i, e in enumerate(edges)]
    counts = ("compared", "orphan_keys", "orphan_rows", "target_surplus")
    return _every_test(frames, tests, "test int, edge string", found, counts)


def orphan_keys(frames: Mapping[str, DataFrame], edge: Edge) -> DataFrame:
    """(k0, …, refs): each child key without a parent and its number of rows."""
    shape = _edge_shape(frames, edge)
    names = _names(len(shape))
    per_key = _key_counts(frames, {0: edge}, shape)
    orphan = all_present(names) & (F.col("refs") > 0) & (F.col("targets") == 0)
    return per_key.where(orphan).select(*names, "refs")


def orphan_examples(frames: Mapping[str, DataFrame], edge: Edge, n: int = 3) -> DataFrame:
    """The first orphan keys in key order."""
    return orphan_keys(frames, edge).orderBy(*_names(len(edge[1]))).limit(n)


def join_fanout(frames: Mapping[str, DataFrame], edges: Sequence[Edge]) -> DataFrame:
    """(edge, rows_before, rows_after): child rows, and rows of the inner join.

    The join's size follows from the counts per key; the join is never run.
    """
    shapes = [_edge_shape(frames, e) for e in edges]
    found = []
    for group in _by_shape(shapes):
        shape = shapes[group[0]]
        per_key = _key_counts(frames, {i: edges[i] for i in group}, shape)
        matched = F.when(all_present(_names(len(shape))), F.col("refs") * F.col("targets"))
        found.append(per_key.groupBy("test").agg(F.sum("refs").alias("rows_before"), F.sum(matched).alias("rows_after")))
    tests = [(i, spell_edge(e)) for i, e in enumerate(edges)]
    return _every_test(frames, tests, "test int, edge string", found, ("rows_before", "rows_after"))
