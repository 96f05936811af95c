"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents and the gaps of open sequences are rows of one table. A round sorts
it by range of size, the largest first, gaps before documents of their size.
Every task sweeps its range: a gap is put on a stack, a document takes the last
one put there, which is its successor, the smallest gap that holds it and that
no larger document has taken. What a range leaves is matched across ranges by
rank, from the counts each task left. Gaps are then updated, and the next round
begins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeproof.llm import bytebpe, frames
from lakeproof.session import local_frame

_GAP, _DOCUMENT = 0, 1
_PLACED, _LEFT, _UNUSED, _RENEWED = range(4)
_SUMMARY = 4  # added to a tag: one row for each task, with the number, the tokens and the least size of its rows


@dataclass(frozen=True)
class Fit:
    """Parameters of the packing.

    Documents that fit ``classes`` times or fewer into a sequence are placed
    class by class, before the smaller ones, as a descending best fit would. A
    class that places less than a ``stalled``-th of its documents in a round gets new sequences.
    A sweep has as many ranges as hold ``range_rows`` rows each.
    """

    capacity: int = 1024
    separator: int = 2
    classes: int = 3
    stalled: int = 64
    range_rows: int = 1 << 16

    def phases(self) -> list[tuple[int, int, int | None]]:
        """Shortest and longest document of each phase, and how many of them a sequence holds."""
        n = self.capacity
        named = [(n // (k + 1) + 1, n // k, k) for k in range(2, self.classes + 1)]
        return [p for p in [*named, (1, n // (self.classes + 1), None)] if p[0] <= p[1]]


def _pieces(source: DataFrame, path: str, fit: Fit) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, key): the documents cut where they must be; ``key`` is a row's own."""
    schema = frames.plus(source.select("doc_id").schema, "piece int, start long, length int, ids_crc32 long, key long")
    arrow = frames.arrow_schema(schema)
    size = fit.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 36
        end = np.array([fit.separator], "<u4").tobytes()
        for batch in batches:
            for i, j, ids, counts in bytebpe.encoded(path, batch, "text"):
                total = counts + 1
                n = -(-total // size)
                row = np.repeat(np.arange(j - i), n)
                piece = np.arange(len(row)) - (np.cumsum(n) - n)[row]
                first = total[row] - (n[row] - 1) * size
                start = np.where(piece == 0, 0, first + (piece - 1) * size)
                length = np.where(piece == 0, first, size)
                at = (np.cumsum(counts) - counts)[row] + start
                last = piece == n[row] - 1
                words = ids.astype("<u4")
                crc = [
                    zlib.crc32(end, zlib.crc32(words[a : b - 1])) if z else zlib.crc32(words[a:b])
                    for a, b, z in zip(at.tolist(), (at + length).tolist(), last.tolist(), strict=True)
                ]
                keys = key + np.arange(len(row))
                key += len(row)
                columns = [batch.column(0).slice(i, j - i).take(pa.array(row)), piece, start, length, np.array(crc, np.int64), keys]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def sweep(kind: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For every document the place of the gap it takes, else -1; rows stand from large to small, gaps first."""
    taken = np.full(len(size), -1, np.int64)
    if not len(size):
        return taken
    change = np.flatnonzero((kind[1:] != kind[:-1]) | (size[1:] != size[:-1])) + 1
    open_: list[list[int]] = []
    for a, b in zip([0, *change.tolist()], [*change.tolist(), len(size)], strict=True):
        if kind[a] == _GAP:
            open_.append([a, b])
            continue
        while a < b and open_:
            first, end = open_[-1]
            n = min(b - a, end - first)
            taken[a : a + n] = np.arange(end - 1, end - n - 1, -1)
            a += n
            if n == end - first:
                open_.pop()
            else:
                open_[-1][1] = end - n
    return taken


@dataclass(frozen=True)
class _Stretch:
    """Ranks [low, high) of a task's leftover documents, and the gap task and rank of the first; or none: they open sequences."""

    task: int
    low: int
    high: int
    gap_task: int | None
    gap_rank: int | None


def across(left: dict[int, int], unused: dict[int, int], opened: int) -> tuple[list[_Stretch], int]:
    """How leftover documents meet unused gaps of earlier ranges, and how many do.

    Of what is left then, the ``opened`` largest documents open sequences.
    """
    out, free, matched = [], [], 0
    for task in sorted({*left, *unused}):
        low, n = 0, left.get(task, 0)
        while low < n and free:
            gap_task, count = free[-1]
            k = min(n - low, count)
            out.append(_Stretch(task, low, low + k, gap_task, count - 1))
            low, matched = low + k, matched + k
            if k == count:
                free.pop()
            else:
                free[-1] = (gap_task, count - k)
        if low < n and opened:
            k = min(n - low, opened)
            out.append(_Stretch(task, low, low + k, None, None))
            opened -= k
        if unused.get(task):
            free.append((task, unused[task]))
    return out, matched


_FIELDS = ("doc_id", "piece", "start", "ids_crc32")


def _events(pieces: DataFrame) -> DataFrame:
    return pieces.select(F.lit(_DOCUMENT).alias("kind"), F.col("length").alias("size"), "key", *_FIELDS)


def _gap(schema: StructType, size: Column, key: Column) -> list[Column]:
    """The columns of a gap; those of documents are null."""
    nothing = [F.lit(None).cast(schema[c].dataType).alias(c) for c in _FIELDS]
    return [F.lit(_GAP).alias("kind"), size.cast("int").alias("size"), key.alias("key"), *nothing]


def _swept(events: DataFrame, ranges: int) -> DataFrame:
    """The events after the sweeps: tag, kind, size, key, fields of the document, sequence_id, offset, task, rank."""
    schema = frames.plus(events.schema, "tag int, sequence_id long, offset long, task int, rank long")
    arrow, names = frames.arrow_schema(schema), events.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = list(batches)
        table = pa.Table.from_batches(listed).combine_chunks() if listed else None
        if table is None or not len(table):
            return
        kind, size, key = (table.column(c).to_numpy() for c in ("kind", "size", "key"))
        taken = sweep(kind, size)
        placed = np.flatnonzero(taken >= 0)
        gap = taken[placed]
        used = np.zeros(len(size), bool)
        used[gap] = True
        left, unused = np.flatnonzero((kind == _DOCUMENT) & (taken < 0)), np.flatnonzero((kind == _GAP) & ~used)
        renewed = size[gap] - size[placed]
        full = renewed == 0
        rows = np.concatenate([placed, left, unused, gap[~full]])
        parts = [len(placed), len(left), len(unused), int((~full).sum())]
        tag = np.repeat([_PLACED, _LEFT, _UNUSED, _RENEWED], parts)
        out = table.select(names).take(pa.array(rows))
        sizes = np.concatenate([size[placed], size[left], size[unused], renewed[~full]])
        mine = tag == _PLACED
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        sequence[mine], offset[mine] = key[gap], -size[gap]
        rank = np.concatenate([np.arange(n) for n in parts])
        task = TaskContext.get().partitionId()
        more = [tag, sequence, offset, np.full(len(rows), task), rank]
        columns = [*out.columns, *more]
        columns[1] = sizes
        columns = [(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c)).cast(f.type) for c, f in zip(columns, arrow, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        told = [
            {"kind": _GAP, "key": 0, "offset": 0, "tag": _SUMMARY + t, "task": task, "rank": n, "size": sizes[tag == t].min(), "sequence_id": sizes[tag == t].sum()}
            for t, n in enumerate(parts)
            if n
        ]
        yield pa.RecordBatch.from_pylist(told, schema=arrow)

    order = [F.col("size").desc(), F.col("kind"), F.xxhash64("key")]
    dealt = events.repartitionByRange(ranges, *order) if ranges > 1 else events.coalesce(1)
    return dealt.sortWithinPartitions(*order).mapInArrow(run, schema)


class _Rounds:
    """The rounds of one packing: gaps at hand, pieces placed so far."""

    def __init__(self, spark: SparkSession, fit: Fit, schema: StructType):
        self.spark, self.fit, self.schema = spark, fit, schema
        self.placed: list[DataFrame] = []

    def open(self, rows: DataFrame) -> None:
        """Each of these pieces opens a sequence, which bears its key."""
        alone = [F.col("size").alias("length"), F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset")]
        self.placed.append(rows.select(*_FIELDS, *alone))
        room = self.fit.capacity - F.col("size")
        self.gaps = rows.where(room > 0).select(*_gap(self.schema, room, F.col("key")))

    def run(self, documents: DataFrame, per_sequence: int | None) -> None:
        """Sweeps until every one of these documents is placed."""
        low, rows = documents.agg(F.min("size"), F.count(F.lit(1))).first()
        if low is None:
            return
        rows += self.gaps.count()
        aside = []  # gaps for smaller documents
        while True:
            aside.append(self.gaps.where(F.col("size") < low))
            events = documents.unionByName(self.gaps.where(F.col("size") >= low))
            swept = frames.materialise(_swept(events, -(-rows // self.fit.range_rows)), "fit-sweep")
            found = swept.where(F.col("tag") >= _SUMMARY).select("tag", "task", "rank", "size", "sequence_id").collect()
            by = lambda tag: {r["task"]: r for r in found if r["tag"] == _SUMMARY + tag}
            count = lambda tag: sum(r["rank"] for r in by(tag).values())
            total = lambda tag: sum(r["sequence_id"] for r in by(tag).values())
            left = {t: r["rank"] for t, r in by(_LEFT).items()}
            unused = {t: r["rank"] for t, r in by(_UNUSED).items()}
            _, matched = across(left, unused, 0)
            placed, remain = count(_PLACED) + matched, count(_LEFT) - matched
            stalled = placed * self.fit.stalled < placed + remain
            if per_sequence is None:
                # Placing moves the same number of tokens out of both sums, so this many sequences are needed in any case.
                room = 0 if placed == 0 else total(_UNUSED) + total(_RENEWED)
                opened = max(0, -(-(total(_LEFT) - room) // self.fit.capacity))
            else:
                opened = -(-remain // per_sequence) if stalled else 0
            stretches, _ = across(left, unused, min(opened, remain))
            self.placed.append(self._rows(swept.where(F.col("tag") == _PLACED)))
            closed = per_sequence is None and placed == 0
            if stretches:
                swept = frames.materialise(self._moved(swept, stretches), "fit-moved")
                self.placed.append(self._rows(swept.where(F.col("tag") == _PLACED)))
            gaps = swept.where(F.col("tag").isin(*([_RENEWED] if closed else [_UNUSED, _RENEWED])))
            self.gaps = gaps.select(*_gap(self.schema, F.col("size"), F.col("key")))
            if remain <= opened:
                break
            documents = swept.where(F.col("tag") == _LEFT).select("kind", "size", "key", *_FIELDS)
            low = min(r["size"] for r in by(_LEFT).values())
            rows = remain + count(_UNUSED) + count(_RENEWED)
        if per_sequence is not None:
            for gaps in aside:
                self.gaps = self.gaps.unionByName(gaps)

    def _rows(self, placed: DataFrame) -> DataFrame:
        """Offsets were stated as minus the gap, which is counted from the sequence's end."""
        offset = F.when(F.col("offset") < 0, F.col("offset") + self.fit.capacity).otherwise(F.col("offset"))
        return placed.select(*_FIELDS, F.col("size").alias("length"), "sequence_id", offset.alias("offset"))

    def _moved(self, swept: DataFrame, stretches: list[_Stretch]) -> DataFrame:
        """What the sweeps left, after leftover documents met gaps of other ranges or opened sequences."""
        rows = [(s.task, s.low, s.high, s.gap_task, s.gap_rank) for s in stretches]
        ddl = "_task int, _low long, _high long, _gap_task int, _gap_rank long"
        plan = F.broadcast(local_frame(self.spark, rows, ddl))  # a few stretches for each task of the sweep
        base = [c for c in swept.columns if c not in ("tag", "sequence_id", "offset")]
        here = (F.col("task") == F.col("_task")) & (F.col("rank") >= F.col("_low")) & (F.col("rank") < F.col("_high"))
        left = swept.where(F.col("tag") == _LEFT).join(plan, here, "left")
        staying = left.where(F.col("_task").isNull()).select(swept.columns)
        going = left.where(F.col("_task").isNotNull())
        opening = going.where(F.col("_gap_task").isNull())
        own = [F.lit(_PLACED).alias("tag"), F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset")]
        room = self.fit.capacity - F.col("size")
        fresh = opening.where(room > 0).select(
            *_gap(self.schema, room, F.col("key")), F.lit(_RENEWED).alias("tag"), F.lit(0).cast("long").alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"), "task", "rank",
        )
        unused = swept.where(F.col("tag") == _UNUSED)
        parts = [staying, opening.select(*base, *own), fresh, swept.where(F.col("tag") == _RENEWED)]
        if all(s.gap_task is None for s in stretches):
            parts.append(unused)
        else:
            parts += self._met(going.where(F.col("_gap_task").isNotNull()), unused, base)
        out = parts[0].select(swept.columns)
        for part in parts[1:]:
            out = out.unionByName(part.select(swept.columns))
        return out

    def _met(self, meeting: DataFrame, unused: DataFrame, base: list[str]) -> list[DataFrame]:
        """Documents in the gaps of other ranges, and the unused gaps with what these leave of them."""
        meeting = meeting.withColumn("_rank", F.col("_gap_rank") - (F.col("rank") - F.col("_low")))
        taken = unused.select(F.col("task").alias("_t"), F.col("rank").alias("_r"), F.col("size").alias("_size"), F.col("key").alias("_key"))
        filled = meeting.select(F.col("_gap_task").alias("_t"), F.col("_rank").alias("_r"), F.col("size").alias("_filled"))
        both = unused.join(filled, (F.col("task") == F.col("_t")) & (F.col("rank") == F.col("_r")), "left")
        tag = F.when(F.col("_t").isNull(), F.lit(_UNUSED)).otherwise(F.lit(_RENEWED))
        gaps = both.withColumn("tag", tag).withColumn("size", F.col("size") - F.coalesce("_filled", F.lit(0)))
        met = meeting.join(taken, (F.col("_gap_task") == F.col("_t")) & (F.col("_rank") == F.col("_r")))
        settled = [F.lit(_PLACED).alias("tag"), F.col("_key").alias("sequence_id"), (-F.col("_size")).cast("long").alias("offset")]
        return [met.select(*base, *settled), gaps.where("size > 0")]


def pack(docs: DataFrame, path: str, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids and the separator; a null or empty text is the
    separator alone. Documents longer than a sequence are cut into whole
    sequences, their first piece taking what is over; no other is cut. Ids may
    be null or repeat; each row is packed on its own, so equal rows give equal
    pieces at different places. An empty table gives no rows. Other columns are
    not read. sequence_id is the number of the piece that opened the sequence.

    A round moves the rows of the pieces that are not placed yet and of the gaps
    that can still hold one, never their ids: some 60 bytes for each. Ranges are
    cut by size and a hash, so a length that a third of all pieces share is
    dealt to as many tasks as it needs; there are as many as the rows ask for.
    The driver sees a few counts for each task of a sweep. Every round is written to the shared folder.

    As many sequences are opened as there must be: in a class of documents that
    fit k times, one for every k left over; then as many as the tokens left
    exceed the room. Rounds follow the number of documents a sequence can hold, not the table.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = frames.materialise(_pieces(source, path, fit), "fit-pieces")
    rounds = _Rounds(docs.sparkSession, fit, pieces.schema)
    events = _events(pieces)
    rounds.open(events.where(F.col("size") > fit.capacity // 2))
    for low, high, per_sequence in fit.phases():
        rounds.run(events.where(F.col("size").between(low, high)), per_sequence)
    out = rounds.placed[0]
    for part in rounds.placed[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def default_path() -> str:
    return public_tokenizers.path(bytebpe.DEFAULT)
