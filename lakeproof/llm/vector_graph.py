"""Near-duplicate vectors by robust-pruned flat graphs over overlapping cluster shards."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeproof.llm import frames
from lakeproof.llm.components import components


@dataclass(frozen=True)
class Graph:
    """Parameters of shards, graphs and search."""

    cosine: float = 0.98
    degree: int = 24
    candidates: int = 64
    beam: int = 16
    alpha: float = 1.2
    shard: int = 2000  # a larger cell is split
    fanout: int = 8
    max_levels: int = 6
    block: int = 2000

    @property
    def expand(self) -> float:
        """The search goes on through vectors that are at least this close: within twice the angle of the cosine."""
        return 2 * max(self.cosine, 0.0) ** 2 - 1 - 1e-6


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _cells(classes: DataFrame, graph: Graph) -> DataFrame:
    """(cell, cid, unit, n, primary): classes in overlapping shards.

    Each class has one primary cell, and all it may be linked with are there too:
    if x is nearest to centre c, x.(d - c) <= 0 for every centre d, so for y
    within the chord r of x, y.(d - c) <= r |d - c|. A class goes to every centre
    where this holds for its own nearest d. A cell whose parts would have more
    than half its pairs again stays whole.
    """
    chord = (2 - 2 * graph.cosine) ** 0.5
    rows = classes.select(F.col("label").cast("string").alias("cell"), "cid", "unit", "n", F.lit(True).alias("primary"))
    done = []
    for level in range(graph.max_levels):
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
        sized = frames.materialise(rows.join(sizes, "cell"), "graph-cells")
        done.append(sized.where(F.col("size") <= graph.shard).drop("size"))
        large = sized.where(F.col("size") > graph.shard)
        if large.isEmpty():
            return _union(done)
        # About as many centres as shards are needed, at most ``fanout``: the classes whose hash is lowest.
        share = F.least(F.lit(graph.fanout + 0.0), F.ceil(F.col("size") * 2 / graph.shard)) / F.col("size")
        drawn = (F.xxhash64("cid", F.lit(level)) / F.lit(2.0**64) + 0.5) < share
        centres = large.where(drawn).groupBy("cell").agg(F.slice(F.sort_array(F.collect_list(F.struct("cid", "unit"))), 1, 4 * graph.fanout).alias("centres"))
        apart = F.transform("centres", lambda c: F.transform("centres", lambda d: F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * _dot(c["unit"], d["unit"])))))
        near = F.transform("centres", lambda c, i: F.struct((-_dot(F.col("unit"), c["unit"])).alias("away"), c["cid"].alias("centre"), i.alias("at")))
        ranked = large.join(centres.withColumn("apart", apart), "cell").withColumn("near", near).withColumn("first", F.array_min("near"))
        reach = lambda c: chord * F.get(F.get("apart", F.col("first.at")), c["at"]) + 1e-9
        within = F.filter("near", lambda c: c["away"] - F.col("first.away") <= reach(c))
        to = F.transform(within, lambda c: F.struct(c["centre"].alias("centre"), (c["centre"] == F.col("first.centre")).alias("nearest")))
        dealt = frames.materialise(ranked.select("cell", "cid", "unit", "n", "primary", "size", to.alias("to")), "graph-dealt")
        parts = dealt.select("cell", "size", F.explode("to.centre").alias("centre")).groupBy("cell", "size", "centre").agg(F.count(F.lit(1)).cast("double").alias("part"))
        pays = parts.groupBy("cell", "size").agg(F.sum(F.col("part") * F.col("part")).alias("pairs")).where(2 * F.col("pairs") <= F.col("size").cast("double") * F.col("size"))
        pays = frames.materialise(pays.select("cell"), "graph-split")
        done.append(large.join(pays, "cell", "left_anti").select("cell", "cid", "unit", "n", "primary"))
        rows = dealt.join(pays, "cell").select("cell", "cid", "unit", "n", "primary", F.inline("to")).select(
            F.concat_ws("/", "cell", "centre").alias("cell"), "cid", "unit", "n", (F.col("primary") & F.col("nearest")).alias("primary")
        )
    return _union([*done, frames.materialise(rows, "graph-cells")])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _units(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def robust_prune(unit: np.ndarray, node: int, candidates: np.ndarray, graph: Graph) -> list[int]:
    """The nearest candidate again and again, without those that a chosen one is ``alpha`` times nearer to."""
    candidates = np.unique(candidates[candidates != node])
    distance = 1 - unit[candidates] @ unit[node]
    order = np.argsort(distance, kind="stable")
    candidates, distance = candidates[order], distance[order]
    chosen: list[int] = []
    while len(candidates) and len(chosen) < graph.degree:
        best = candidates[0]
        chosen.append(int(best))
        keep = graph.alpha * (1 - unit[candidates] @ unit[best]) > distance
        keep[0] = False
        candidates, distance = candidates[keep], distance[keep]
    return chosen


def greedy(unit: np.ndarray, links: list[list[int]], query: np.ndarray, start: int, beam: int) -> np.ndarray:
    """Nodes visited by a best-first walk that keeps the ``beam`` nearest."""
    seen = {start}
    nodes, scores, open_ = np.array([start]), np.array([unit[start] @ query]), np.array([True])
    visited = []
    while open_.any():
        at = int(np.flatnonzero(open_)[np.argmax(scores[open_])])
        open_[at] = False
        visited.append(int(nodes[at]))
        fresh = [k for k in links[nodes[at]] if k not in seen]
        if fresh:
            seen.update(fresh)
            nodes = np.append(nodes, fresh)
            scores = np.append(scores, unit[fresh] @ query)
            open_ = np.append(open_, np.ones(len(fresh), bool))
            if len(nodes) > beam:
                top = np.argpartition(-scores, beam)[:beam]
                nodes, scores, open_ = nodes[top], scores[top], open_[top]
    return np.unique(np.append(visited, nodes))


def _in_range(closeness: np.ndarray, node: int, links: list[int], cosine: float) -> list[int]:
    """Further links, until every row in range is linked or is nearer to a linked row than to ``node``.

    So a step along links leads from any row nearer to any row in its range; of
    rows equally near the one of the lower number counts as nearer.
    """
    row = closeness[node]
    rest = np.flatnonzero(row >= cosine - 1e-9)
    rest = rest[(rest != node) & ~np.isin(rest, links)]
    more: list[int] = []
    for link in links:
        rest = rest[~_nearer(closeness, link, node, rest)]
    while len(rest):
        best = int(rest[np.argmax(row[rest])])
        more.append(best)
        rest = rest[(rest != best) & ~_nearer(closeness, best, node, rest)]
    return more


def _nearer(closeness: np.ndarray, a: int, b: int, rows: np.ndarray) -> np.ndarray:
    """Which of the rows are nearer to ``a`` than to ``b``."""
    x, y = closeness[a, rows], closeness[b, rows]
    return (x > y) | ((x == y) & (a < b))


def islands(links: list[set[int]]) -> np.ndarray:
    """The connected part of each row."""
    part = np.full(len(links), -1)
    for start in range(len(links)):
        todo = [start] if part[start] < 0 else []
        part[todo] = start
        while todo:
            fresh = [k for k in links[todo.pop()] if part[k] < 0]
            part[fresh] = start
            todo += fresh
    return part


def _bridge(links: list[set[int]], closeness: np.ndarray) -> None:
    """Links each island with the nearest row outside, until the graph is connected."""
    part = islands(links)
    while part.any():
        for name in np.unique(part):
            inside, outside = np.flatnonzero(part == name), np.flatnonzero(part != name)
            near = closeness[np.ix_(inside, outside)]
            i, k = np.unravel_index(near.argmax(), near.shape)
            links[inside[i]].add(int(outside[k]))
            links[outside[k]].add(int(inside[i]))
        part = islands(links)


def build(unit: np.ndarray, graph: Graph) -> list[list[int]]:
    """A flat graph over the rows of a shard: each is linked with its nearest by robust pruning, in both directions.

    A shard is small enough to know every row's nearest exactly. Links go on
    beyond ``candidates`` and ``degree`` until no row in range is out of reach,
    and the graph is connected.
    """
    closeness = unit @ unit.T
    take = min(graph.candidates, len(unit) - 1)
    links = [robust_prune(unit, i, np.argpartition(-row, take)[: take + 1], graph) for i, row in enumerate(closeness)]
    links = [x + _in_range(closeness, i, x, graph.cosine) for i, x in enumerate(links)]
    # Backward links are not pruned again: a row at a cluster's rim is often reached by its own links alone.
    # Together they are no more than the forward ones.
    back: list[set[int]] = [set(x) for x in links]
    for i, x in enumerate(links):
        for k in x:
            back[k].add(i)
    _bridge(back, closeness)
    return [sorted(x) for x in back]


def search(unit: np.ndarray, links: list[list[int]], medoid: int, graph: Graph) -> list[np.ndarray]:
    """For every row the others at ``cosine`` or more: a walk from the medoid, then on through everything in range.

    Each step from the row towards one in its range stays within that range of
    the latter, so within twice the angle of the row: all in range are found.
    """
    ahead = [np.array(x, np.int64) for x in links]
    out = []
    for node in range(len(unit)):
        pool = np.zeros(len(unit), bool)
        edge = np.unique(np.concatenate([greedy(unit, links, unit[node], medoid, graph.beam), ahead[node]]))
        pool[edge] = True
        while len(edge):
            edge = edge[unit[edge] @ unit[node] >= graph.expand]
            fresh = np.unique(np.concatenate([ahead[k] for k in edge])) if len(edge) else edge
            edge = fresh[~pool[fresh]]
            pool[edge] = True
        pool[node] = False
        near = np.flatnonzero(pool)
        out.append(near[unit[near] @ unit[node] >= graph.cosine])
    return out


_FOUND = "a string, b string, n_links long, kind string"
_FOUND_ARROW = pa.schema([("a", pa.string()), ("b", pa.string()), ("n_links", pa.int64()), ("kind", pa.string())])


def _report(cids: list[str], n: np.ndarray, primary: np.ndarray, pairs: set[tuple[int, int]]) -> pa.Table:
    """Counts for the rows at home in this cell, and a forest of the pairs with such a row.

    A row's links are all in its primary cell, so they are counted there and nowhere else.
    """
    counts, parent, rows = np.zeros(len(cids), np.int64), list(range(len(cids))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, k in sorted(pairs):
        if not (primary[i] or primary[k]):
            continue
        if primary[i]:
            counts[i] += n[k]
        if primary[k]:
            counts[k] += n[i]
        a, b = root(i), root(k)
        if a != b:
            parent[a] = b
            rows.append((cids[i], cids[k], 0, "edge"))
    rows += [(cids[i], None, int(c), "count") for i, c in enumerate(counts) if c]
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 4, _FOUND_ARROW.types, strict=True)], schema=_FOUND_ARROW)


def _found(cells: DataFrame, graph: Graph) -> DataFrame:
    """Links within cells: by graphs in cells of at most ``shard`` classes, block by block in larger ones."""
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    sized = cells.join(sizes, "cell")

    def graphs(group: pa.Table) -> pa.Table:
        unit, cids = _units(group.column("unit")), group.column("cid").to_pylist()
        links = build(unit, graph)
        lists = [[cids[k] for k in x] for x in links]
        return pa.table([pa.array(cids), pa.array(lists, pa.list_(pa.string()))], names=["cid", "links"])

    flat = frames.materialise(sized.where(F.col("size") <= graph.shard).drop("size"), "graph-shards")
    made = flat.groupBy("cell").applyInArrow(graphs, "cid string, links array<string>")
    union = made.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))
    joined = flat.join(union, "cid")

    def walk(group: pa.Table) -> pa.Table:
        unit, cids = _units(group.column("unit")), group.column("cid").to_pylist()
        place = {c: i for i, c in enumerate(cids)}
        links = [[place[c] for c in x if c in place] for x in group.column("links").to_pylist()]
        medoid = int(np.argmax(unit @ unit.mean(0)))
        near = search(unit, links, medoid, graph)
        pairs = {(min(i, int(k)), max(i, int(k))) for i, x in enumerate(near) for k in x}
        return _report(cids, group.column("n").to_numpy(), group.column("primary").to_numpy(), pairs)

    def grid(group: pa.Table) -> pa.Table:
        unit, cids, block = _units(group.column("unit")), group.column("cid").to_pylist(), group.column("block").to_numpy()
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        i, k = np.nonzero(unit[left] @ unit[right].T >= graph.cosine)
        pairs = {(min(a, b), max(a, b)) for a, b in zip(left[i].tolist(), right[k].tolist(), strict=True) if a != b}
        return _report(cids, group.column("n").to_numpy(), group.column("primary").to_numpy(), pairs)

    n = F.ceil(F.col("size") * 2 / graph.block).cast("int")
    block = F.pmod(F.xxhash64("cid", F.lit("block")), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.least(block, k).alias("x"), F.greatest(block, k).alias("y")))
    large = sized.where(F.col("size") > graph.shard).select("cell", "cid", "unit", "n", "primary", block.alias("block"), F.inline(pairs))
    return joined.groupBy("cell").applyInArrow(walk, _FOUND).unionByName(large.groupBy("cell", "x", "y").applyInArrow(grid, _FOUND))


def near_vectors(
    vectors: DataFrame, graph: Graph = Graph(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows of equal label are linked when the cosine of their vectors, in double
    precision, reaches ``graph.cosine``. Null labels, and vectors that are null,
    empty, zero or hold a null or a non-finite component link with nothing and
    are their own component. component_id is the smallest vec_id reachable; a
    null id stands behind all others. Vectors of different lengths are never
    compared. Rows of equal label and vector are copies: linked with each other,
    and searched for once. Repeated ids are rows like others. An empty table
    gives an empty result. Other columns are not read.

    Reported links are exact, and all of them are found (see ``_in_range``,
    ``search`` and ``_cells``; ``audit_recall`` measures it). Classes of copies are dealt into overlapping shards: cells that
    are too large are split around a few of their own members, and what lies
    between centres goes to all of them, so that every row meets all its links in
    its primary cell, where they are counted. Cells that do not fall apart are
    compared block by block, exactly.
    """
    source = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.col(f"`{label_col}`").alias("label"))
    usable = F.coalesce(_usable(F.col("v")) & F.col("label").isNotNull(), F.lit(False))
    tag = lambda k: F.hex(F.xxhash64(F.lit(k), F.col("label").cast("string"), F.col("v")))
    rows = source.withColumn("cid", F.when(usable, F.concat(F.lpad(tag(0), 16, "0"), F.lpad(tag(1), 16, "0"))))
    rows = frames.materialise(rows.select("vec_id", "cid", "v", "label"), "graph-rows")
    # Scaled by the largest component first, so that no square overflows or vanishes.
    top = F.array_max(F.transform("v", F.abs))
    scaled = F.transform("v", lambda x: x / F.col("top"))
    unit = F.transform("scaled", lambda x: x / F.sqrt(F.col("norm")))
    classes = rows.where("cid is not null").groupBy("cid").agg(F.first("v").alias("v"), F.first("label").alias("label"), F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("top", top).withColumn("scaled", scaled).withColumn("norm", _dot(F.col("scaled"), F.col("scaled")))
    classes = classes.select("cid", unit.alias("unit"), "n", F.concat_ws(":", F.col("label").cast("string"), F.size("v").cast("string")).alias("label"))
    classes = frames.materialise(classes, "graph-classes")

    found = frames.step(_found(_cells(classes, graph), graph), "graph-links")
    links = found.where("kind = 'count'").groupBy("a").agg(F.sum("n_links").alias("other"))
    labels = components(found.where("kind = 'edge'").select("a", "b"), "graph-components")

    labelled = (
        rows.select("vec_id", "cid")
        .join(classes.select(F.col("cid").alias("_c"), "n"), F.col("cid") == F.col("_c"), "left")
        .join(links.withColumnRenamed("a", "_a"), F.col("cid") == F.col("_a"), "left")
        .join(labels.select(F.col("node").alias("_node"), F.col("label").alias("_label")), F.col("cid") == F.col("_node"), "left")
        .select("vec_id", "cid", F.coalesce("_label", "cid").alias("part"), (F.coalesce("other", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("n_links"))
    )
    least = labelled.where("part is not null").groupBy(F.col("part").alias("_part")).agg(F.min("vec_id").alias("_least"))
    joined = labelled.join(least, F.col("part") == F.col("_part"), "left")
    component = F.when(F.col("part").isNull(), F.col("vec_id")).otherwise(F.col("_least"))
    return joined.select("vec_id", "n_links", component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def audit_recall(vectors: DataFrame, found: DataFrame, every: int = 50, cosine: float = 0.98) -> tuple[int, int]:
    """Links found and links there are, of every row whose id is divisible by ``every``, by comparison with all rows of its label."""
    unit = F.transform("v", lambda x: x / F.sqrt(_dot(F.col("v"), F.col("v"))))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v")).where(_usable(F.col("v"))).select("vec_id", "label", unit.alias("unit"))
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("q"), "label", F.col("unit").alias("u"))
    truth = asked.join(rows, "label").where((F.col("q") != F.col("vec_id")) & (_dot(F.col("u"), F.col("unit")) >= cosine)).groupBy("q").count()
    both = truth.join(found.select(F.col("vec_id").alias("q"), "n_links"), "q").agg(F.sum(F.least("n_links", "count")), F.sum("count")).collect()[0]
    return int(both[0] or 0), int(both[1] or 0)
