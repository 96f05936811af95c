"""Hierarchical multi-length packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakeproof.llm import bytebpe, frames

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 1 << 16
PART_BITS = 36


class Piece:
    """A stretch of one document's ids that lies in one sequence."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc: int | None, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class TieredPacker:
    """Packs the documents of one task; holds one batch of them and less than one window besides.

    A document gives whole windows of the longest tier as long as it can. What
    is left goes to the shortest tier that holds it. Tiers are packed from the
    longest down: a window opens with a document of its tier, its gap is filled
    with whole documents of the longest shorter tier that fits, and when none
    fits, with a cut one. Only a task's last tokens can be short of a window;
    they are laid out in windows whose lengths are powers of two, so no
    sequence needs padding.
    """

    def __init__(self, tiers: Sequence[int] = TIERS, first_id: int = 0):
        if list(tiers) != sorted(tiers) or any(t & (t - 1) for t in tiers):
            raise ValueError("tiers must be ascending powers of two")
        self.tiers, self.first_id = list(tiers), first_id
        self.pools: list[list[Piece]] = [[] for _ in tiers]
        self.used = 0
        self.per_length: dict[int, int] = {}
        self.rows: list[tuple] = []
        self.held: list[Piece] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        top, n = self.tiers[-1], len(ids)
        whole = n - n % top
        for at in range(0, whole, top):
            self._emit([Piece(doc, at, ids[at : at + top], n)])
        if n > whole:
            self._route(Piece(doc, whole, ids[whole:], n))

    def _route(self, piece: Piece) -> None:
        self.pools[next(k for k, t in enumerate(self.tiers) if len(piece.ids) <= t)].append(piece)

    def _emit(self, window: list[Piece]) -> None:
        """Write one full sequence, numbered among those of its length."""
        length = sum(len(p.ids) for p in window)
        nth = self.per_length.get(length, 0)
        self.per_length[length] = nth + 1
        at = 0
        for p in window:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            self.rows.append((p.doc, p.start, len(p.ids), crc, p.total, self.first_id + self.used, at, length, nth))
            at += len(p.ids)
        self.used += 1

    def _filler(self, tier: int, gap: int) -> Piece | None:
        """A whole document that fits the gap, else one to cut, from the tiers up to ``tier``."""
        for k in reversed(range(tier + 1)):
            if self.tiers[k] <= gap and self.pools[k]:
                return self.pools[k].pop()
        for k in range(tier + 1):
            if self.pools[k]:
                return self.pools[k].pop()
        return None

    def pack(self) -> None:
        """Close every window that the documents at hand can fill."""
        for tier in reversed(range(len(self.tiers))):
            size, pool = self.tiers[tier], self.pools[tier]
            while pool:
                window = [pool.pop()]
                gap = size - len(window[0].ids)
                while gap:
                    piece = self._filler(tier, gap)
                    if piece is None:
                        break
                    if len(piece.ids) > gap:
                        piece, rest = piece.cut(gap)
                        self._route(rest)
                    window.append(piece)
                    gap -= len(piece.ids)
                if gap:  # nothing else is left in this tier or below
                    self.held += window
                    break
                self._emit(window)

    def flush(self, last: bool) -> list[tuple]:
        """Rows of all closed windows; with ``last``, the remaining tokens too."""
        self.held = []
        self.pack()
        left = self.held
        if last:
            while left:
                room = 1 << (min(sum(len(p.ids) for p in left), self.tiers[-1]).bit_length() - 1)
                window = []
                while room:
                    piece = left.pop(0)
                    if len(piece.ids) > room:
                        piece, rest = piece.cut(room)
                        left.insert(0, rest)
                    window.append(piece)
                    room -= len(piece.ids)
                self._emit(window)
        else:
            for p in left:
                self._route(p)
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    path: str,
    tiers: Sequence[int] = TIERS,
    separator: int = 0,
    step_tokens: int = STEP_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where each stretch of each document's ids lies.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    sequence's tier (its length) and step_group. A null or empty text is the
    separator alone. Ids may be null or repeat; each row is packed on its own,
    so equal rows give equal pieces at different places. An empty table gives no
    rows. Other columns are not read.

    Every task packs the documents it reads, so no text is shuffled and a task's
    loss repeats that task alone. A task leaves no padding, hence their number
    costs nothing but up to a few short sequences each.

    A step group holds sequences of one length with ``step_tokens`` tokens in
    all; only the last group of a length has fewer. Sequences of a length are
    numbered through over all tasks, for which the pieces are written to the
    shared folder and read again.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = frames.plus(
        source.select("doc_id").schema,
        "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, nth long",
    )
    arrow = frames.arrow_schema(schema)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = TieredPacker(tiers, TaskContext.get().partitionId() << PART_BITS)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for i, j, ids, counts in bytebpe.encoded(path, batch, "text"):
                ends = np.cumsum(counts)
                for r in range(i, j):
                    own = ids[ends[r - i] - counts[r - i] : ends[r - i]]
                    packer.add(ids_of[r], np.append(own, separator))
                yield table(packer.flush(last=False))
        yield table(packer.flush(last=True))

    pieces = frames.materialise(source.mapInArrow(run, schema), "packed-pieces")
    part = F.shiftright("sequence_id", PART_BITS)
    # One row for each task and length, and a dozen lengths at most.
    sizes = pieces.where("offset = 0").groupBy(part.alias("_part"), F.col("tier").alias("_tier")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_tier").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_part", "_tier", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    joined = pieces.join(frames.materialise(base, "packed-parts"), (part == F.col("_part")) & (F.col("tier") == F.col("_tier")))
    per_group = F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("tier")))
    group = F.col("tier") * (1 << PART_BITS) + F.floor((F.col("_base") + F.col("nth")) / per_group)
    return joined.select(*[c for c in pieces.columns if c != "nth"], group.cast("long").alias("step_group"))


def default_path() -> str:
    return public_tokenizers.path(bytebpe.DEFAULT)
