"""MinHash near-dedup by a chosen-path similarity join.

Documents with equal shingle sets form a class at once. Classes are sorted into
independent trees: a node passes its classes on to children chosen by minwise
values, at coordinates that the path itself draws; a path goes on at 1.25
coordinates on average, the inverse of the similarity sought, so that a similar
pair is as likely to meet at a deep node as at a shallow one. Nodes that are small enough
are compared exhaustively, on full shingle sets, where the signatures leave a
link possible; a pair that meets in several trees is looked at in the first.
Larger nodes are first compared with a few of their own members
(pivots), and fall apart further only if they still hold more than one component.
The deeper they had to fall, the more trees their classes are sorted into.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeproof.llm import arrays, frames, shingles
from lakeproof.llm.components import components

_U = np.uint64
# Likely pairs for each text beyond which intersections are computed together.
PAIRS_EACH = 32


@dataclass(frozen=True)
class Join:
    """Parameters of the similarity join.

    Links are pairs with 100 * intersection >= percent * union. ``miss`` is the
    probability with which a pair at the threshold may be missed; a tenth of it
    is for the comparison of signatures.
    """

    words: int = 5
    percent: int = 80
    signature: int = 128
    trees: int = 8
    node_limit: int = 4000
    pivots: int = 2
    max_depth: int = 8
    miss: float = 1e-4

    @property
    def equal(self) -> list[float]:
        """How likely a pair at the threshold shares 0, 1, … signature values."""
        p, n = self.percent / 100, self.signature
        return [comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]

    @property
    def least_equal(self) -> int:
        """Signature values two classes must share to be looked at."""
        return int(np.searchsorted(np.cumsum(self.equal), self.miss / 10, side="right"))

    def missed(self, trees: int, depth: int) -> float:
        """How likely no tree brings a pair at the threshold together, where nodes are split down to ``depth``.

        The first trees hold all classes; the others only those of nodes that
        were split on, so a pair must have met at depth two before.
        """
        out = 0.0
        for k, weight in enumerate(self.equal):
            two = (1 - _meets(k / self.signature, 2)) ** self.trees
            deep = 1 - _meets(k / self.signature, depth)
            out += weight * (two + (deep**self.trees - two) * deep ** (trees - self.trees))
        return out

    def trees_for(self, depth: int) -> int:
        """Trees that keep what is missed under ``miss``, or as near to it as the first trees let it be."""
        goal = max(self.miss * 0.9, self.missed(self.trees, 2) * 1.01)
        trees = self.trees
        while self.missed(trees, depth) > goal:
            trees += 1
        return trees


def _meets(similarity: float, depth: int) -> float:
    """How likely a pair that shares so much of its signature is together in a node of this depth of a tree."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - similarity * p) * (1 - similarity * p / 4)
    return p


def _signature_rows(source: DataFrame, join: Join) -> DataFrame:
    """(doc_id, key, n, cid, sig); documents without words have neither class nor signature."""
    schema = frames.plus(source.select("doc_id", "key").schema, "n long, cid binary, sig binary")
    arrow = frames.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_buffer(batch.column(2))
            for i, j in arrays.blocks(offsets, arrays.BLOCK_BYTES // 2):
                part = offsets[i : j + 1] - offsets[i]
                h, bounds = shingles.shingle_sets(data[offsets[i] : offsets[j]], part, join.words)
                n = np.diff(bounds)
                cid = np.stack([x.astype(">u8") for x in shingles.fingerprints(h, bounds)], 1).tobytes()
                sig = shingles.signatures(h, bounds, join.signature).tobytes()
                size = 4 * join.signature
                cids = [cid[16 * k : 16 * k + 16] if n[k] else None for k in range(j - i)]
                sigs = [sig[size * k : size * k + size] if n[k] else None for k in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in (0, 1)), pa.array(n), pa.array(cids, pa.binary()), pa.array(sigs, pa.binary())],
                    schema=arrow,
                )

    return source.mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def _children(path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and path of every child of each row's node."""
    rows, out = [], []
    for branch in range(2):
        draw = arrays.mix(path ^ _U(0xA0761D6478BD642F + branch))
        chosen = np.arange(len(path)) if branch == 0 else np.flatnonzero((draw >> _U(32)) % _U(4) == 0)
        at = (draw[chosen] % _U(sig.shape[1])).astype(np.int64)
        with np.errstate(over="ignore"):
            out.append(arrays.mix(path[chosen] + arrays.mix(sig[chosen, at] + (_U(1 + branch) << _U(40)) + (at.astype(_U) << _U(48)))))
        rows.append(chosen)
    return np.concatenate(rows), np.concatenate(out)


def _plant(classes: DataFrame, join: Join, trees: range) -> DataFrame:
    """(tree, path, cid): the nodes of depth two that each class reaches in these trees."""
    arrow = pa.schema([("tree", pa.int32()), ("path", pa.int64()), ("cid", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _matrix(batch.column(1), join.signature)
            for tree in trees:
                row, path = np.arange(len(sig)), np.full(len(sig), arrays.mix(np.array([tree + 1], _U))[0])
                for _ in range(2):
                    more, path = _children(path, sig[row])
                    row = row[more]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), tree, np.int32)), pa.array(path.view(np.int64)), batch.column(0).take(pa.array(row))], schema=arrow)

    return classes.select("cid", "sig").mapInArrow(run, "tree int, path long, cid binary")


def _split(nodes: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """The children of large nodes."""
    arrow = pa.schema([("tree", pa.int32()), ("path", pa.int64()), ("cid", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, path = _children(batch.column(1).to_numpy().view(_U), _matrix(batch.column(3), join.signature))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(path.view(np.int64)), batch.column(2).take(at)], schema=arrow)

    return nodes.select("tree", "path", "cid").join(classes.select("cid", "sig"), "cid").select("tree", "path", "cid", "sig").mapInArrow(run, "tree int, path long, cid binary")


def _sized(nodes: DataFrame) -> DataFrame:
    """Rows of nodes with two classes or more, and the number in their node."""
    counts = nodes.groupBy("tree", "path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return nodes.join(counts, ["tree", "path"])


def _nodes_of(sig: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of depth two that each row reaches in the first trees: paths (row, tree, up to four), and which exist."""
    paths, there = np.zeros((len(sig), trees, 4), _U), np.zeros((len(sig), trees, 4), bool)
    for tree in range(trees):
        row, path = np.arange(len(sig)), np.full(len(sig), arrays.mix(np.array([tree + 1], _U))[0])
        for _ in range(2):
            more, path = _children(path, sig[row])
            row = row[more]
        order = np.argsort(row, kind="stable")
        row, path = row[order], path[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        paths[row, tree, nth], there[row, tree, nth] = path, True
    return paths, there


def _possible(small: DataFrame, large: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """Rows of small nodes whose signature leaves a link to another class possible that they meet here first."""
    arrow = pa.schema([("tree", pa.int32()), ("path", pa.int64()), ("cid", pa.binary())])

    def near(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sig = _matrix(group.column("sig"), join.signature)
        tree = group.column("tree")[0].as_py()
        paths, there = _nodes_of(sig, tree)
        # A node that is large is no place where a pair has been looked at.
        for row, trees in enumerate(group.column("large").to_pylist()):
            there[row, [t for t in trees or [] if t < tree]] = False
        found = np.zeros(len(sig), bool)
        for i in range(len(sig) - 1):
            hit = i + 1 + np.flatnonzero((sig[i + 1 :] == sig[i]).sum(1) >= join.least_equal)
            if len(hit):
                met = np.zeros(len(hit), bool)
                for x in range(4):
                    met |= ((paths[hit] == paths[i, :, x, None]) & there[hit] & there[i, :, x, None]).any((1, 2))
                found[hit[~met]] = True
                found[i] |= not met.all()
        return group.select(["tree", "path", "cid"]).filter(pa.array(found)).cast(arrow)

    trees = large.groupBy(F.col("cid").alias("_cid")).agg(F.collect_set("tree").alias("large"))
    rows = small.select("tree", "path", "cid").join(classes.select("cid", "sig"), "cid")
    rows = rows.join(trees, F.col("cid") == F.col("_cid"), "left").select("tree", "path", "cid", "sig", "large")
    return rows.groupBy("tree", "path").applyInArrow(near, "tree int, path long, cid binary")


def _forest(linked: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked, none within a part: rows in the order of their links, a link to each new part."""
    out = []
    for i in np.argsort(-linked.sum(1), kind="stable").tolist():
        near = np.flatnonzero(linked[i] & (part != part[i]))
        if len(near):
            parts, first = np.unique(part[near], return_index=True)
            out += [(i, int(near[k])) for k in first]
            part[np.isin(part, parts)] = part[i]
    return out


def _linked(texts: list[bytes], join: Join, labels: list[bytes]) -> list[tuple[int, int]]:
    """A spanning forest of the links between texts of different labels.

    Starting with the text that may have most links, each is compared with all
    it may be linked with, but for those connected already. Where many pairs may
    be linked, the sizes of all intersections are computed at once.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h, bounds = shingles.shingle_sets(data, offsets, join.words)
    sig = shingles.signatures(h, bounds, join.signature)
    equal = np.stack([(sig == row).sum(1).astype(np.int16) for row in sig])
    equal[equal < join.least_equal] = 0
    _, part = np.unique(np.array(labels, object), return_inverse=True)
    if np.count_nonzero(equal) > PAIRS_EACH * len(texts):
        size = np.diff(bounds)
        both = shingles.intersections(h, bounds)
        linked = equal > 0
        for i in range(len(texts)):
            linked[i] &= 100 * both[i] >= join.percent * (size + size[i] - both[i])
        return _forest(linked, part)
    out = []
    for i in np.argsort(-(equal > 0).sum(1), kind="stable").tolist():
        maybe = np.flatnonzero((equal[i] > 0) & (part != part[i]))
        for k in maybe[np.argsort(-equal[i, maybe], kind="stable")].tolist():
            if part[k] == part[i]:
                continue
            x, y = h[bounds[i] : bounds[i + 1]], h[bounds[k] : bounds[k + 1]]
            both = shingles.common(x, y)
            equal[k, i] = 0
            if 100 * both >= join.percent * (len(x) + len(y) - both):
                part[part == part[k]] = part[i]
                out.append((i, k))
    return out


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _compare(rows: DataFrame, texts: DataFrame, keys: list[str], join: Join) -> DataFrame:
    """Edges (a, b): links within the groups ``keys`` of (…, cid, label), as a forest for each group."""

    def links(group: pa.Table) -> pa.Table:
        cids, labels = group.column("cid").to_pylist(), group.column("label").to_pylist()
        order = sorted(range(len(cids)), key=cids.__getitem__)
        cids, labels = [cids[i] for i in order], [labels[i] for i in order]
        raw = [t.encode("utf-8") for t in group.column("text").to_pylist()]
        found = _linked([raw[i] for i in order], join, labels)
        return pa.table([[cids[i] for i, _ in found], [cids[k] for _, k in found]], schema=_EDGES)

    return rows.join(texts, "cid").select(*keys, "cid", "label", "text").groupBy(*keys).applyInArrow(links, "a binary, b binary")


def _pairs_linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, join: Join) -> DataFrame:
    """Those of the pairs (a, b) that are links: first by signature, then on full sets."""

    def by_signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_matrix(batch.column(c), join.signature) for c in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=_EDGES).filter(pa.array((x == y).sum(1) >= join.least_equal))

    def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([t.encode("utf-8") for t in batch.column(c).to_pylist()] for c in (2, 3))
            hit = [bool(_linked([a, b], join, [b"a", b"b"])) for a, b in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=_EDGES).filter(pa.array(hit, pa.bool_()))

    def attach(edges: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            other = table.select(F.col("cid").alias("_cid"), F.col(column).alias(f"{column}_{side}"))
            edges = edges.join(other, F.col(side) == F.col("_cid")).drop("_cid")
        return edges.select("a", "b", f"{column}_a", f"{column}_b")

    likely = attach(pairs, classes, "sig").mapInArrow(by_signature, "a binary, b binary")
    return attach(likely, texts, "text").mapInArrow(by_text, "a binary, b binary")


class _Labels:
    """Links found so far, and the component of every class that has one."""

    def __init__(self, classes: DataFrame):
        self.spark, self.edges, self.table = classes.sparkSession, None, None

    def add(self, edges: DataFrame) -> None:
        edges = frames.step(edges, "near-edges")
        if edges.isEmpty():
            return
        self.edges = edges if self.edges is None else self.edges.unionByName(edges)
        self.table = components(self.edges, "near-components")

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of their class."""
        if self.table is None:
            return rows.withColumn("label", F.col("cid"))
        table = self.table.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        joined = rows.join(table, rows["cid"] == table["_node"], "left")
        return joined.withColumn("label", F.coalesce("_label", "cid")).drop("_node", "_label")

    def unsettled(self, nodes: DataFrame) -> DataFrame:
        """Rows of nodes that hold more than one component."""
        rows = self.attach(nodes)
        several = rows.groupBy("tree", "path").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low <> _high")
        return rows.join(several.select("tree", "path"), ["tree", "path"])


def _settle_large(large: DataFrame, classes: DataFrame, texts: DataFrame, labels: _Labels, join: Join, depth: int) -> DataFrame:
    """Compares the members of large nodes with their pivots; rows of nodes that are still not one component."""
    pivot = [F.min(F.struct(F.xxhash64("cid", F.lit(depth * join.pivots + k)), "cid"))["cid"] for k in range(join.pivots)]
    chosen = large.groupBy("tree", "path").agg(F.array(*pivot).alias("pivots"))
    pairs = (
        large.join(chosen, ["tree", "path"])
        .select("cid", F.explode("pivots").alias("pivot"))
        .where("cid <> pivot")
        .select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
        .distinct()
    )
    labels.add(_pairs_linked(pairs, classes, texts, join))
    return frames.step(labels.unsettled(large.select("tree", "path", "cid")).select("tree", "path", "cid"), "near-large")


def _grid(rows: DataFrame, join: Join) -> DataFrame:
    """Nodes that stay large, cut into blocks; every two blocks of a node meet in one cell, so all pairs are compared.

    Blocks come from a hash of the class, as many as the node needs.
    """
    sized = _sized(rows)
    n = F.ceil(F.col("size") * 2 / join.node_limit).cast("int")
    block = F.pmod(F.xxhash64("cid", F.lit("block")), n).cast("int")
    cells = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.least(block, k).alias("x"), F.greatest(block, k).alias("y")))
    return sized.select("tree", "path", "cid", F.inline(cells))


def _settle_nodes(large: DataFrame, classes: DataFrame, texts: DataFrame, labels: _Labels, join: Join) -> tuple[list[DataFrame], DataFrame | None, int]:
    """Finds the links within large nodes, down to small ones: the rows of those, the classes of nodes that were split, the depth reached."""
    small, crowd = [], None
    for depth in range(join.max_depth):
        if not large.isEmpty():
            large = _settle_large(large, classes, texts, labels, join, depth)
        if large.isEmpty():
            return small, crowd, 2 + depth
        crowd = frames.step(large.select("cid").distinct(), "near-crowd") if crowd is None else crowd
        children = frames.step(_sized(_split(large, classes, join)), "near-children")
        small.append(children.where(F.col("size") <= join.node_limit).select("tree", "path", "cid"))
        large = labels.unsettled(children.where(F.col("size") > join.node_limit).select("tree", "path", "cid"))
        large = frames.step(large.select("tree", "path", "cid"), "near-large")
    if not large.isEmpty():
        labels.add(_compare(labels.attach(_grid(large, join)), texts, ["tree", "path", "x", "y"], join))
    return small, crowd, 2 + join.max_depth


def _settle(small: DataFrame, large: DataFrame, classes: DataFrame, texts: DataFrame, labels: _Labels, join: Join) -> None:
    """Finds the links within nodes; then in further trees over the classes of nodes that were split, as many as the depth reached asks for."""
    rows, crowd, depth = _settle_nodes(large, classes, texts, labels, join)
    planted = join.trees
    while True:
        for more in rows:
            small = small.unionByName(more)
        labels.add(_compare(labels.unsettled(small), texts, ["tree", "path"], join))
        if crowd is None or join.trees_for(depth) <= planted:
            return
        trees = range(planted, join.trees_for(depth))
        nodes = frames.step(_sized(_plant(classes.join(crowd, "cid"), join, trees)), "near-nodes")
        small = nodes.where(F.col("size") <= join.node_limit).select("tree", "path", "cid")
        rows, _, reached = _settle_nodes(nodes.where(F.col("size") > join.node_limit).select("tree", "path", "cid"), classes, texts, labels, join)
        planted, depth = trees.stop, max(depth, reached)


def near_duplicates(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, key, n_shingles, component_id, component, kept.

    Two documents are linked when the Jaccard similarity of their sets of word
    shingles reaches the threshold; A-Z count as a-z. A document with fewer words
    than a shingle has its whole sequence as one; a document without words, an
    empty or a null text has none, is linked with nothing and is its own
    component. component_id is the smallest doc_id reachable by links, itself
    included; kept says that it is the document's own. A null id stands behind
    all others, so it is a component's id only if all are null. Ids may
    repeat, so components may share one; ``component`` is the component's own
    label, null without words. Equal rows get equal answers. ``key`` tells apart rows of equal id. An empty table gives an
    empty result. Other columns are not read.

    Every link that is reported is confirmed on full shingle sets (64-bit
    hashes). A pair is missed if no tree brings it together, or its signatures
    differ too much, with a probability below 1e-4 at the threshold and less
    above it, however deep its nodes are split (see ``Join.missed``).

    Classes of equal sets count as one, so thousands of copies weigh nothing.
    Members of a large node are compared with a few pivots, never with each
    other; rows made in a node are at most its members or a forest of links.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    source = source.select("doc_id", frames.row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    rows = frames.materialise(_signature_rows(source, join), "near-signatures")
    classes = rows.where("n > 0").groupBy("cid").agg(F.first("sig").alias("sig"), F.min(F.struct("doc_id", "key")).alias("at"))
    classes = frames.step(classes, "near-classes")

    nodes = frames.step(_sized(_plant(classes, join, range(join.trees))), "near-nodes")
    few = nodes.where(F.col("size") <= join.node_limit)
    large = nodes.where(F.col("size") > join.node_limit).select("tree", "path", "cid")
    small = frames.step(_possible(few, large, classes, join), "near-possible")
    wanted = small.select("cid").union(large.select("cid")).distinct().join(classes, "cid").select("cid", F.col("at.doc_id").alias("_doc_id"), F.col("at.key").alias("_key"))
    texts = source.join(wanted, frames.same(("doc_id", "_doc_id"), ("key", "_key"))).dropDuplicates(["cid"]).select("cid", "text")
    texts = frames.step(texts, "near-texts")

    labels = _Labels(classes)
    _settle(small, large, classes, texts, labels, join)

    labelled = labels.attach(rows.select("doc_id", "key", "n", "cid"))
    least = labelled.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("_least")).withColumnRenamed("label", "_of")
    joined = labelled.join(least, F.col("label") == F.col("_of"), "left")
    component = F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("label").alias("component")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The rows of ``docs`` that are the one left of their component; all columns as they are.

    That is the row of the smallest id, of repeated ones the first by key, of
    equal rows one. Documents without words all stay, equal rows as one.
    """
    found = near_duplicates(docs, join).where("kept")
    alone = found.where("n_shingles = 0").select("doc_id", "key")
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("at"))
    kept = alone.union(first.select("at.doc_id", "at.key")).distinct()
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("key").alias("_kept"))
    tagged = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").alias("_doc"),
        frames.row_key(F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))).alias("_key"),
    )
    one = tagged.join(kept, frames.same(("_doc", "_id"), ("_key", "_kept"))).dropDuplicates(["_doc", "_key"])
    return one.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
