"""Token ids in training order: a keyed permutation of all sequences, written in fixed-stride shards."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakeproof.llm import arrays, bytebpe, frames

_U = np.uint64


class Feistel:
    """A keyed permutation of 0 … n-1: a Feistel network over an even number of bits, walked until it lands inside."""

    def __init__(self, n: int, key: int, rounds: int = 4):
        self.n = n
        self.half = _U(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = _U((1 << int(self.half)) - 1)
        self.keys = arrays.mix(np.arange(1, rounds + 1, dtype=_U) + _U(key * 0x9E3779B97F4A7C15 % (1 << 64) >> 1))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys:
            left, right = right, left ^ (arrays.mix(right ^ k) & self.mask)
        return left << self.half | right

    def slots(self, index: np.ndarray) -> np.ndarray:
        """The slot of each index. The domain is less than four times n, so walks are short."""
        out = self._once(index.astype(_U))
        outside = np.flatnonzero(out >= _U(self.n))
        while len(outside):
            out[outside] = self._once(out[outside])
            outside = outside[out[outside] >= _U(self.n)]
        return out.astype(np.int64)


def sequences(docs: DataFrame, path: str, length: int, separator: int, pad: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, nth, doc_id, start, n_tokens, ids): every task's documents as one stream, cut into equal sequences.

    doc_id and start tell where the sequence begins. Only the last sequence of a
    task is filled up with ``pad``. ids are deflated (``zlib``), since they are
    stored and moved once each and ids of 16 bits shrink by a third.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "part int, nth long, " + f"doc_id {source.schema['doc_id'].dataType.simpleString()}, start long, n_tokens int, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, width = TaskContext.get().partitionId(), 0, np.uint16 if bytebpe.load(path).size <= 1 << 16 else np.uint32
        rest, owners = np.zeros(0, width), []  # owners: (doc, its first token's place in the stream from rest's begin)
        kind = None

        def table(streams: list[np.ndarray], marks: list[tuple]) -> pa.RecordBatch:
            nonlocal nth
            n = len(streams)
            out = [
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(nth, nth + n)),
                pa.array([m[0] for m in marks], kind),
                pa.array([m[1] for m in marks], pa.int64()),
                pa.array([m[2] for m in marks], pa.int32()),
                pa.array([zlib.compress(np.pad(s, (0, length - len(s)), constant_values=pad).tobytes(), 1) for s in streams], pa.binary()),
            ]
            nth += n
            return pa.RecordBatch.from_arrays(out, names=["part", "nth", "doc_id", "start", "n_tokens", "ids"])

        for batch in batches:
            kind, docs_of = batch.column(0).type, batch.column(0).to_pylist()
            for i, j, ids, counts in bytebpe.encoded(path, batch, "text"):
                ends = np.cumsum(counts)
                stream = np.insert(ids, ends, separator).astype(width)
                begin = np.concatenate([[0], np.cumsum(counts + 1)[:-1]]) + len(rest)
                owners += list(zip(docs_of[i:j], begin.tolist(), strict=True))
                stream = np.concatenate([rest, stream])
                whole = len(stream) // length
                if whole:
                    at = np.searchsorted([o[1] for o in owners], np.arange(whole) * length, side="right") - 1
                    marks = [(owners[k][0], x * length - owners[k][1], length) for x, k in enumerate(at.tolist())]
                    yield table([stream[x * length : (x + 1) * length] for x in range(whole)], marks)
                rest = stream[whole * length :]
                last = max((k for k, o in enumerate(owners) if o[1] <= whole * length), default=0)
                owners = [(d, b - whole * length) for d, b in owners[last:]]
        if len(rest):
            yield table([rest], [(owners[0][0], -owners[0][1], len(rest))])

    return source.mapInArrow(run, schema)


def training_shards(
    docs: DataFrame,
    path: str,
    length: int = 512,
    per_shard: int = 1024,
    seed: int = 11,
    separator: int = 50256,
    pad: int = 50256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(shard, first_slot, n_sequences, stride, payload): all sequences in training order.

    Texts are tokenised, each followed by ``separator``, and cut into sequences
    of ``length`` ids. A keyed permutation gives every sequence its slot among
    all; slot s lies in shard s // per_shard at byte (s % per_shard) * stride of
    its payload, little-endian ids of 16 bits where the vocabulary allows, else
    32. So a reader that stopped after any slot goes on from there, and any
    slot's place is known without an index. ``write_shards`` stores the result.

    A null or empty text gives a separator. Rows are told apart by where they
    are read, so ids may be null or repeat. An empty table gives no shards.
    Other columns are not read. Sequences are written to the shared folder once,
    so their numbering rests on stored rows and survives lost tasks; they are
    then moved once, to range partitions of whole shards, and sorted by slot.
    """
    stored = frames.materialise(sequences(docs, path, length, separator, pad, id_col, text_col), "training-sequences")
    sizes = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each task. Written first, so that its size is known when the join is planned and the ids are not shuffled for it.
    base = frames.materialise(sizes.select(F.col("part").alias("_part"), before.alias("base")), "training-parts")
    n = stored.count()
    order = Feistel(n, seed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = order.slots(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(slots // per_shard), pa.array(slots), batch.column(1)], names=["shard", "slot", "ids"])

    placed = stored.join(base, F.col("part") == F.col("_part")).select((F.col("base") + F.col("nth")).alias("index"), "ids")
    placed = placed.mapInArrow(place, "shard long, slot long, ids binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards of a range, one after another; a task holds one of them."""
        shard, slot, rows = None, None, []
        for batch in batches:
            for s, at, ids in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if s != shard and rows:
                    yield one(shard, slot, rows)
                    rows = []
                if not rows:
                    shard, slot = s, at
                rows.append(zlib.decompress(ids))
        if rows:
            yield one(shard, slot, rows)

    def one(shard: int, slot: int, rows: list[bytes]) -> pa.RecordBatch:
        values = [shard, slot, len(rows), len(rows[0]), b"".join(rows)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["shard", "first_slot", "n_sequences", "stride", "payload"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

    ranged = placed.repartitionByRange("shard").sortWithinPartitions("slot")
    return ranged.mapInArrow(pack, "shard long, first_slot long, n_sequences long, stride long, payload binary")


def write_shards(shards: DataFrame, path: str) -> None:
    """Store shards as they come: every file holds a range of neighbouring shards in order, so reading them is sequential.

    A folder that exists is an error, so a stored order is never mixed with
    another. An empty table is stored as one without shards.
    """
    shards.write.parquet(path)


def read_from(stored: DataFrame, slot: int, per_shard: int) -> DataFrame:
    """The shards from the one that holds ``slot`` on, in order, each with the byte at which to go on (``from_byte``).

    Files whose range ends before are not read, by the bounds in their footers.
    A slot behind the last one, or an empty table, gives no rows; a negative
    slot is an error.
    """
    if slot < 0:
        raise ValueError("slots are counted from 0")
    first = slot // per_shard
    skip = F.when(F.col("shard") == first, F.lit(slot % per_shard) * F.col("stride")).otherwise(F.lit(0))
    rest = stored.where((F.col("shard") >= first) & (F.col("first_slot") + F.col("n_sequences") > slot))
    return rest.withColumn("from_byte", skip).orderBy("shard")


def default_path() -> str:
    return public_tokenizers.path(bytebpe.DEFAULT)
