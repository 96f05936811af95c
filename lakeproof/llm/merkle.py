"""A Merkle manifest of a dataset whose parents keep the hash state before each child.

Leaves stand in order within their group and are cut into tiles of a bounded
number, a power of the arity. A tile is one task's subtree; the roots of tiles
are the leaves of the next layer of tiles, up to one node for each group, and
these are joined in the same way. Folding takes a replaced child, resumes the
state its parent kept before that child's slot, and hashes the child and what
stands to its right; what stands to its left is in the state already.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeproof.llm import frames, midstates


@dataclass(frozen=True)
class Shape:
    """Children of a node, and levels of a tile."""

    arity: int = 2
    levels: int = 12

    @property
    def width(self) -> int:
        return self.arity**self.levels


# One level of a tree, as arrays of digests (n, 8)


def parents(values: np.ndarray, arity: int) -> tuple[np.ndarray, np.ndarray]:
    """The parents of consecutive nodes, and for every node the state its parent kept before its slot."""
    n = len(values)
    state, before = midstates.fresh(-(-n // arity)), np.empty_like(values)
    for slot in range(arity):
        child = np.arange(slot, n, arity)
        before[child] = state[child // arity]
        state[child // arity] = midstates.absorb(before[child], values[child])
    return midstates.finish(state, _run_lengths(n, arity)), before


def _run_lengths(n: int, arity: int) -> np.ndarray:
    return np.minimum(arity, n - arity * np.arange(-(-n // arity)))


def folded(at: np.ndarray, value: np.ndarray, values: np.ndarray, before: np.ndarray, arity: int) -> np.ndarray:
    """The parents' digests if the nodes ``at`` had these values: the kept state, the value, the right siblings."""
    state = midstates.absorb(before[at], value)
    for step in range(1, arity):
        right = at + step
        there = np.flatnonzero((right < len(values)) & (right // arity == at // arity))
        state[there] = midstates.absorb(state[there], values[right[there]])
    return midstates.finish(state, _run_lengths(len(values), arity)[at // arity])


def _told_apart(at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of each different (node, value)."""
    rows = np.concatenate([at[:, None].astype(np.int64).view(np.uint32), value], 1)
    _, first, number = np.unique(np.ascontiguousarray(rows).view([("", np.uint32)] * rows.shape[1]).ravel(), return_index=True, return_inverse=True)
    return first, number.ravel()


def levels_of(n: int, group: int, shape: Shape) -> int:
    """Levels that a tile of n nodes rises where its group has ``group`` nodes."""
    if group > shape.width:
        return shape.levels
    levels = 0
    while n > 1:
        n, levels = -(-n // shape.arity), levels + 1
    return levels


# Frames: g names the group, "" for null and "=…" for others, so that text order puts null first


def _group_key(group: Column) -> Column:
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def numbered(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with their place in their group ``g``, in this order (null first), and the group's size.

    The order is a range sort; a task's rows are numbered where they lie, and
    what stands before them comes from one count for each task and group.
    """
    by = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order], F.col("_salt")]
    sorted_ = rows.withColumn("_salt", F.rand(1)).repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    placed = frames.materialise(sorted_.withColumn("_at", F.monotonically_increasing_id()), label)
    task = F.shiftright("_at", 33).alias("_task")
    counts = placed.groupBy("g", task).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    here = Window.partitionBy("g")
    before = here.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("g").alias("_g"), F.col("_task").alias("_of"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(here).alias("n")
    )
    joined = placed.withColumn("_task", F.shiftright("_at", 33)).join(counts, (F.col("g") == F.col("_g")) & (F.col("_task") == F.col("_of")))
    return joined.select(*[c for c in rows.columns], (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"), "n")


def _tile(shape: Shape) -> Column:
    return F.floor(F.col("pos") / shape.width).cast("long").alias("tile")


_PATHS = "g string, pos long, n long, path array<binary>, top binary"


def _layer(nodes: DataFrame, shape: Shape) -> DataFrame:
    """Each node with its path through its tile; the first node of a tile has the tile's root.

    A step of a path: the numbers of left and right siblings, the state before
    the node's slot, and the siblings' digests.
    """
    k = shape.arity
    arrow = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("path", pa.list_(pa.binary())), ("top", pa.binary())])

    def climb(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        values = midstates.words(b"".join(group.column("value").to_pylist()))
        paths: list[list[bytes]] = [[] for _ in range(len(group))]
        at = np.arange(len(group))
        for _ in range(levels_of(len(group), group.column("n")[0].as_py(), shape)):
            above, before = parents(values, k)
            steps = []
            for i in range(len(values)):
                low, high = i - i % k, min(i - i % k + k, len(values))
                siblings = np.concatenate([values[low:i], values[i + 1 : high]])
                steps.append(bytes([i - low, high - i - 1]) + midstates.packed(before[i : i + 1]) + midstates.packed(siblings))
            for row, i in enumerate(at.tolist()):
                paths[row].append(steps[i])
            values, at = above, at // k
        top = [midstates.packed(values)] + [None] * (len(group) - 1)
        return pa.table([*(group.column(c) for c in ("g", "pos", "n")), pa.array(paths, pa.list_(pa.binary())), pa.array(top, pa.binary())], schema=arrow)

    return nodes.select("g", "pos", "n", "value", _tile(shape)).groupBy("g", "tile").applyInArrow(climb, _PATHS)


def _next_nodes(layer: DataFrame, shape: Shape) -> DataFrame:
    above = F.ceil(F.col("n") / shape.width).cast("long").alias("n")
    return layer.where("top IS NOT NULL").select("g", _tile(shape).alias("pos"), above, F.col("top").alias("value"))


def paths(nodes: DataFrame, shape: Shape) -> DataFrame:
    """(g, pos, path, apex) of nodes (g, pos, n, value): the steps up to the one node of the group, and that node."""
    layers, current = [], nodes
    while (current.agg(F.max("n")).first()[0] or 1) > 1:
        layers.append(frames.materialise(_layer(current, shape), "manifest-layer"))
        current = _next_nodes(layers[-1], shape)
    out = current.select("g", "pos", F.array().cast("array<binary>").alias("path"), F.col("value").alias("apex"))
    for layer in reversed(layers):
        above = out.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("path").alias("_path"), "apex")
        own = layer.select("g", "pos", "path", _tile(shape))
        joined = own.join(above, (F.col("g") == F.col("_g")) & (F.col("tile") == F.col("_pos")))
        out = joined.select("g", "pos", F.concat("path", "_path").alias("path"), "apex")
    return frames.materialise(out, "manifest-paths")


def _lowest(leaves: DataFrame, shape: Shape) -> DataFrame:
    """Each leaf after its tile: the value it or its replacement folds to, the state of its proof so far; the first with the tile's root."""
    schema = frames.plus(leaves.select("id", "g", "pos", "n", "leaf").schema, "fold binary, proof binary, blocks long, top binary")
    arrow = frames.arrow_schema(schema)
    k = shape.arity

    def climb(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        leaf, other = group.column("leaf").to_pylist(), group.column("other").to_pylist()
        values = midstates.words(b"".join(leaf))
        fold = midstates.words(b"".join(o or x for o, x in zip(other, leaf, strict=True)))
        lane, proof, blocks, at = np.arange(len(leaf)), midstates.fresh(len(leaf)), np.zeros(len(leaf), np.int64), np.arange(len(leaf))
        node = at
        for _ in range(levels_of(len(leaf), group.column("n")[0].as_py(), shape)):
            above, before = parents(values, k)
            for slot in range(k):
                sibling = at - at % k + slot
                there = np.flatnonzero((sibling < len(values)) & (sibling != at))
                proof[there] = midstates.absorb(proof[there], values[sibling[there]])
                blocks[there] += 1
            # Leaves that fold to the same value of the same node go on as one.
            fold, node = folded(node, fold, values, before, k), node // k
            first, number = _told_apart(node, fold)
            fold, node, lane = fold[first], node[first], number[lane]
            values, at = above, at // k
        folds, proofs = midstates.packed(fold), midstates.packed(proof)
        columns = [
            *(group.column(c) for c in ("id", "g", "pos", "n", "leaf")),
            pa.array([folds[32 * i : 32 * i + 32] for i in lane.tolist()], pa.binary()),
            pa.array([proofs[32 * i : 32 * i + 32] for i in range(len(leaf))], pa.binary()),
            pa.array(blocks),
            pa.array([midstates.packed(values)] + [None] * (len(leaf) - 1), pa.binary()),
        ]
        return pa.table(columns, schema=arrow)

    return leaves.select("id", "g", "pos", "n", "leaf", "other", _tile(shape)).groupBy("g", "tile").applyInArrow(climb, schema)


def _hex(values: np.ndarray) -> list[str]:
    raw = midstates.packed(values).hex()
    return [raw[i : i + 64] for i in range(0, len(raw), 64)]


def _steps(path: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """State before the slot, left and right siblings of every step."""
    for step in path:
        w = midstates.words(step[2:])
        yield w[:1], w[1 : 1 + step[0]], w[1 + step[0] :]


def _completed(low: DataFrame, tops: DataFrame, shape: Shape) -> DataFrame:
    """The leaves of each tile after the tile's path to the root."""
    schema = frames.plus(low.select("id").schema, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    arrow = frames.arrow_schema(schema)

    def finish(leaves: pa.Table, path: pa.Table) -> pa.Table:
        if not len(leaves):
            return arrow.empty_table()
        joined = lambda c: midstates.words(b"".join(leaves.column(c).to_pylist()))
        fold, proof, blocks = joined("fold"), joined("proof"), leaves.column("blocks").to_numpy().copy()
        first, lane = _told_apart(np.zeros(len(fold), np.int64), fold)
        fold = fold[first]
        for before, left, right in _steps(path.column("path")[0].as_py()):
            state = midstates.absorb(np.repeat(before, len(fold), 0), fold)
            for sibling in right:
                state = midstates.absorb(state, np.repeat(sibling[None], len(fold), 0))
            fold = midstates.finish(state, np.full(len(fold), len(left) + 1 + len(right)))
            for sibling in (*left, *right):
                proof = midstates.absorb(proof, np.repeat(sibling[None], len(proof), 0))
            blocks += len(left) + len(right)
        subroot, root = (path.column(c)[0].as_py().hex() for c in ("subroot", "root"))
        reached = _hex(fold)
        folded_root = [reached[i] for i in lane.tolist()]
        n = len(leaves)
        columns = [
            leaves.column("id"), [x.hex() for x in leaves.column("leaf").to_pylist()], [subroot] * n, [root] * n,
            _hex(midstates.finish(proof, blocks)), folded_root, [r == root for r in folded_root],
        ]
        return pa.table(columns, schema=arrow)

    tiles = low.select("id", "g", "leaf", "fold", "proof", "blocks", _tile(shape))
    tops = tops.toDF(*tops.columns)  # columns of its own: both sides come from one table
    return tiles.groupBy("g", "tile").cogroup(tops.groupBy("g", "tile")).applyInArrow(finish, schema)


def spelled(column: Column) -> Column:
    """A value as a leaf spells it: '-' for null, else its UTF-8 length, a colon and itself."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[spelled(v) for v in values]), 256))


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    tampered: Mapping[str, Column],
    tampers: Column,
    group_col: str = "lang",
    id_col: str = "doc_id",
    shape: Shape = Shape(),
) -> DataFrame:
    """The manifest and its verification: one row for each row of ``docs``, the id under its own name.

    leaf, subroot (of its group), root, proof_sha256 (the hash of its siblings
    on the way to the root, left to right, level by level) of the documents as
    they are; folded_root, what the root would be with the ``tampered`` values
    in place of the named columns where ``tampers`` holds; verified, whether that is the root.

    Null groups come first, then bytewise; within a group null ids first. Equal
    ids stand in the order of their leaves, so the root does not depend on the
    order of the rows, and equal rows are leaves side by side. A null or an empty text has its own
    spelling. A lone leaf is its own subroot, and a lone subroot the root. An
    empty table has no rows. Columns not named are not read.

    Texts are hashed where they are read and never shuffled. Each row then moves
    three times, as some 150 bytes: to its place, to its tile, and to its tile's
    path. No task holds more than a tile.
    """
    col = lambda c: F.col(f"`{c}`")
    changed = [tampered.get(c, col(c)) for c in columns]
    source = docs.select(
        col(id_col).alias("id"),
        _group_key(col(group_col)).alias("g"),
        leaf_hash([col(c) for c in columns]).alias("leaf"),
        F.when(tampers, leaf_hash(changed)).alias("other"),
    )
    low = frames.materialise(_lowest(numbered(source, ["id", "leaf"], "manifest-leaves"), shape), "manifest-tiles")
    nodes = _next_nodes(low, shape)
    groups = paths(nodes, shape)
    subroots = groups.where("pos = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("apex").alias("value"))
    ranked = frames.materialise(numbered(subroots, ["name"], "manifest-groups"), "manifest-subroots")
    above = paths(ranked.select("g", "pos", "n", "value"), shape).withColumnRenamed("apex", "root")
    roots = ranked.join(above.select(F.col("pos").alias("_pos"), F.col("path").alias("_path"), "root"), F.col("pos") == F.col("_pos"))
    roots = roots.select(F.col("name").alias("_name"), "_path", "root")
    tops = groups.join(roots, F.col("g") == F.col("_name")).select(
        "g", F.col("pos").alias("tile"), F.concat("path", "_path").alias("path"), F.col("apex").alias("subroot"), "root"
    )
    return _completed(low, tops, shape).withColumnRenamed("id", id_col)
