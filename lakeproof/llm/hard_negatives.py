"""Hard-negative mining: exact scores of anchors against all vectors, block by block."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeproof.llm import frames
from lakeproof.llm.residue_product import product

# Components beyond this size would give scores beyond 64 bits.
LARGEST = 1 << 20


@dataclass(frozen=True)
class Mining:
    """What is searched: positives of an anchor, negatives of a positive, and the band of their scores in percent of the positive's.

    ``anchor_rows`` times ``block_rows`` scores are held at once.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    anchor_rows: int = 2048
    block_rows: int = 4096


_NEAR = "anchor long, row long, vec_id long, score long"
_HARD = "anchor long, positive long, row long, vec_id long, score long"


def participants(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label: Column, is_anchor: Column) -> DataFrame:
    """(row, vec_id, label, anchor, x): rows with a label and a whole finite vector; x holds floor(scale * component)."""
    vector = F.col(f"`{vector_col}`")
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    small = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= F.lit(LARGEST / scale), F.lit(False)))
    anchor = F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"), anchor, F.when(small, x).alias("x"))
    return named.where("label IS NOT NULL AND x IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), "*")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _ordered(group: pa.Table) -> pa.Table:
    """By vec_id, null last, then by row: the first of equal scores is the one to take."""
    return group.sort_by([("vec_id", "ascending"), ("row", "ascending")])


def _labels(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the labels of two tables, equal where the labels are."""
    both = pa.chunked_array([*a.column("label").chunks, *b.column("label").chunks]).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy()
    return codes[: len(a)], codes[len(a) :]


def _first(scores: np.ndarray, allowed: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Line and place of the best allowed score of each line, then of the next one, ``count`` times; of equal ones the first."""
    lowest = np.iinfo(np.int64).min
    left = np.where(allowed, scores, lowest)
    lines = np.flatnonzero(allowed.any(1))
    for _ in range(count):
        if not len(lines):
            return
        at = left[lines].argmax(1)
        there = left[lines, at] != lowest
        lines, at = lines[there], at[there]
        yield lines, at
        left[lines, at] = lowest


def _cells(table: DataFrame, own: str, rows: int, other: str, blocks: int) -> DataFrame:
    """The table dealt into blocks, once for every block of the other side."""
    n = F.pmod(F.xxhash64("row", F.lit(own)), F.lit(rows)).cast("int").alias(own)
    return table.select("*", n, F.size("x").alias("width")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


_KEYS = ["width", "anchors", "block"]


def _best(rows: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The ``count`` best rows of each key, numbered; equal scores by vec_id, null last, then by row."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    mining: Mining = Mining(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of the vectors, components taken as
    floor(scale * component); higher comes first, ties by smaller id (null last),
    then in the order of the rows. The positives of an anchor are its best
    other rows of the same label, all if there are fewer; the negatives of a positive the
    best rows of another label whose score is in the band of the positive's.
    A positive without a row in its band gives nothing.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part, nor do those with a component beyond ±2^20 / scale, whose
    scores would leave 64 bits. Vectors meet those of their own length only; empty ones score
    0. Ids may be null or repeat: every row is its own anchor, positive and
    negative, a repeated one another row of equal score. An empty table gives no rows. Other columns are not read.

    Anchors and rows are dealt into blocks by hash, and each pair of blocks is
    one task's matrix product; first rows of the anchor's label, later of all
    others. A task returns its few best per anchor, or per anchor and positive,
    and the best of these are taken.
    """
    label = F.col("label") if label is None else label
    rows = frames.materialise(participants(vectors, mining.scale, id_col, vector_col, label, is_anchor), "mining-rows")
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    a, b = (max(1, -(-n // size)) for n, size in ((counted["anchors"], mining.anchor_rows), (counted["n"], mining.block_rows)))
    anchors = rows.where("anchor").drop("anchor")
    blocks = _cells(rows.drop("anchor"), "block", b, "anchors", a)
    near_schema, hard_schema = (pa.schema([(f.split()[0], pa.int64()) for f in ddl.split(", ")]) for ddl in (_NEAR, _HARD))

    def scored(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = left.column("width")[0].as_py()
        return product(_matrix(left.column("x"), width), _matrix(right.column("x"), width)), *_labels(left, right)

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            right = _ordered(right)
            mine, other = left.column("row").to_numpy(), right.column("row").to_numpy()
            scores, x, y = scored(left, right)
            allowed = (x[:, None] == y) & (mine[:, None] != other)
            for line, at in _first(scores, allowed, mining.positives):
                found.append((mine[line], other[at], right.column("vec_id").take(pa.array(at)), scores[line, at]))
        return _gathered(found, near_schema)

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            right = _ordered(right)
            mine, other = left.column("row").to_numpy(), right.column("row").to_numpy()
            scores, x, y = scored(left, right)
            hundred, differs = 100 * scores, x[:, None] != y
            listed = left.column("positives").to_pylist()
            for k in range(mining.positives):
                here = np.array([i for i, p in enumerate(listed) if len(p) > k], np.int64)
                if not len(here):
                    break
                bar = np.array([listed[i][k]["score"] for i in here], np.int64)[:, None]
                of = np.array([listed[i][k]["row"] for i in here], np.int64)
                allowed = differs[here] & (hundred[here] >= mining.low * bar) & (hundred[here] <= mining.high * bar)
                for line, at in _first(scores[here], allowed, mining.negatives):
                    found.append((mine[here[line]], of[line], other[at], right.column("vec_id").take(pa.array(at)), scores[here[line], at]))
        return _gathered(found, hard_schema)

    def search(left: DataFrame, fn, ddl: str) -> DataFrame:
        dealt = _cells(left, "anchors", a, "block", b)
        dealt = dealt.toDF(*dealt.columns)  # columns of its own: both sides come from one table
        return dealt.groupBy(*_KEYS).cogroup(blocks.groupBy(*_KEYS)).applyInArrow(fn, ddl)

    near_rows = _best(search(anchors, near, _NEAR), ["anchor"], mining.positives)
    positives = frames.materialise(near_rows.withColumnRenamed("rank", "nth"), "mining-positives")
    held = positives.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))  # a few for each anchor
    asked = anchors.join(held.withColumnRenamed("anchor", "_anchor"), F.col("row") == F.col("_anchor")).drop("_anchor")
    best = _best(search(asked, hard, _HARD), ["anchor", "positive"], mining.negatives)
    best = best.select("anchor", "positive", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    own = positives.select(F.col("anchor").alias("_a"), F.col("row").alias("_p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("_row"), F.col("vec_id").alias("anchor_id"))
    out = best.join(own, (F.col("anchor") == F.col("_a")) & (F.col("positive") == F.col("_p"))).join(ids, F.col("anchor") == F.col("_row"))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _gathered(found: list[tuple], schema: pa.Schema) -> pa.Table:
    if not found:
        return schema.empty_table()
    columns = []
    for parts in zip(*found, strict=True):
        chunks = [c for p in parts for c in (p.chunks if isinstance(p, pa.ChunkedArray) else [pa.array(p)])]
        columns.append(pa.chunked_array(chunks, pa.int64()))
    return pa.table(columns, schema=schema)
