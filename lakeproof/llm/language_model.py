"""Language-model scoring by stupid backoff, as joins of exploded n-grams with a table of counts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lakeproof.llm import arrays, frames

_U = np.uint64
_STRETCH = 1 << 19  # words whose n-grams are held at a time
_HELD = 1 << 20  # n-grams that a task holds before it sends them on
_BUCKET = 1 << 18  # n-grams of a lot that meet in one group
_FEWEST = 64  # groups at least
_COPIES = 1 << 12  # length of the arrays that repeat a row
_LONG = 64  # bytes of a word that are hashed eight at a time
_SEED = _U(0xD6E8FEB86659FD93)
_MARKS = 20  # bits of a hash that tell most n-grams from the frequent ones
_COUNTS = "size int, h long, c long"
_OWN = ("keys", "n", "skip", "frequent")
_ASKED = "bucket int, stretch long, h binary, at binary, " + ", ".join(f"{name} binary" for name in _OWN)
_LAST = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


@dataclass(frozen=True)
class Model:
    """Order of the model, factor for each step back, and the count from which an n-gram of two words or more is in the table.

    N-grams that stand for more than one in ``frequent`` of all words are
    looked up where they are read: at most ``frequent`` of each length. N-grams
    are counted in half of ``lots`` by their hash, one lot after the other, and
    looked up in half as many lots again of documents, so that the disk holds
    the shuffle of one lot at a time; up to ``whole`` words in all, in one.
    """

    order: int = 3
    backoff: float = 0.4
    min_count: int = 2
    frequent: int = 100_000
    lots: int = 4
    whole: int = 4_000_000


def _word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time; those over 64 bytes by ``span_hash``."""
    lengths = ends - starts
    eights = np.ndarray((len(data) + 1,), np.dtype("<u8"), np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    with np.errstate(over="ignore"):
        out = arrays.mix((eights[starts] & _LAST[np.minimum(lengths, 8)]) + lengths.astype(_U) * _SEED)
        more = np.flatnonzero((lengths > 8) & (lengths <= _LONG))
        for done in range(8, _LONG, 8):
            more = more[lengths[more] > done]
            if not len(more):
                break
            rest = eights[starts[more] + done] & _LAST[np.minimum(lengths[more] - done, 8)]
            out[more] = arrays.mix(arrays.mix(out[more]) * _SEED + rest)
    if len(long := np.flatnonzero(lengths > _LONG)):
        out[long] = arrays.span_hash(data, starts[long], ends[long])
    return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of an n-gram, of those of it without its last and without its first word."""
    with np.errstate(over="ignore"):
        return arrays.mix(arrays.mix(a + _SEED) * _SEED + b)


def _chained(words: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each length, the hashes of the n-grams that end with the words, from the first word that can end one."""
    h = words
    for size in range(1, order + 1):
        if size > 1:
            h = _pair(h[:-1], h[1:])
        yield size, h


def _nth(n: np.ndarray) -> np.ndarray:
    """The place of every word in its row, of the words that each row has."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _pieces(column: pa.Array, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of texts: their first row, the hashes of their words, how many of them each row has, and how many of
    these stood in the stretch before and come again, for the n-grams that begin there."""
    data, offsets = arrays.text_buffer(column)
    for i, j in arrays.blocks(offsets):
        block = data[offsets[i] : offsets[j]]
        starts, ends, row = arrays.word_spans(block, offsets[i : j + 1] - offsets[i])
        words = _word_hash(block, starts, ends)
        for first in range(0, max(len(words), 1), _STRETCH):
            last = min(first + _STRETCH, len(words))
            begin = max(0, first - order + 1)
            top = row[first - 1] if first else 0
            low, high = min(top, row[begin]) if first else 0, j - i if last == len(words) else row[last - 1] + 1
            n, skip = (np.bincount(row[begin:x] - low, minlength=high - low).astype(np.int32) for x in (last, first))
            yield i + int(low), words[begin:last], n, skip


def _buckets(n: int = 0) -> int:
    """Groups in which ``n`` n-grams meet; they follow the n-grams alone, not the cluster."""
    return min(max(_FEWEST, n // _BUCKET), 1 << 16)


def _packed(x: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of an array that end at ``ends``, as bytes: Spark moves these whole, not value by value."""
    offsets = (np.concatenate([np.zeros(1, np.int64), ends]) * x.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])


def _unpacked(rows: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows, and how many each row has."""
    column = rows.column(name).combine_chunks()
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind), np.diff(at) // np.dtype(kind).itemsize


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(buckets) >> _U(32)).astype(np.uint16)


def _parcels(hashes: np.ndarray, buckets: int, /, **columns: np.ndarray) -> tuple[pa.Array, dict[str, np.ndarray], np.ndarray]:
    """The buckets of the hashes, the columns in their order, and where each bucket ends."""
    bucket = _bucket(hashes, buckets)
    by = np.argsort(bucket, kind="stable")
    first = _firsts(bucket[by])
    return pa.array(bucket[by[first]], pa.int32()), {name: x[by] for name, x in columns.items()}, np.append(first, len(by))[1:]


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))


def _in_lot(h: np.ndarray, lot: int, lots: int) -> np.ndarray:
    return h[(h & _U(0xFFFFFFFF)) * _U(lots) >> _U(32) == _U(lot)] if lots > 1 else h


def gram_parcels(source: DataFrame, sizes: Sequence[int], lot: int, lots: int, buckets: int) -> DataFrame:
    """(size, bucket, h, n): the n-grams in a lot, packed, each with its count in a stretch of texts."""

    def parcels(size: int, held: list[np.ndarray]) -> pa.RecordBatch:
        h = np.sort(np.concatenate(held))  # buckets are ranges of hashes
        at = _firsts(h)
        n = np.diff(np.append(at, len(h))).astype(np.int32)
        h = h[at]
        bucket = _bucket(h, buckets)
        first = _firsts(bucket)
        ends = np.append(first, len(h))
        counts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n))
        columns = [pa.array(np.full(len(first), size, np.int32)), pa.array(bucket[first], pa.int32()), _packed(h, ends[1:]), counts]
        return pa.RecordBatch.from_arrays(columns, names=["size", "bucket", "h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {size: [] for size in sizes}
        waiting = dict.fromkeys(sizes, 0)
        for batch in batches:
            for _, words, n, skip in _pieces(batch.column(0), max(sizes)):
                nth = _nth(n)
                new = nth >= np.repeat(skip, n)
                for size, h in _chained(words, max(sizes)):
                    if size in sizes and len(h):
                        mine = _in_lot(h[(nth[size - 1 :] >= size - 1) & new[size - 1 :]], lot, lots)
                        held[size].append(mine)
                        waiting[size] += len(mine)
                        if waiting[size] >= _HELD:
                            yield parcels(size, held[size])
                            held[size], waiting[size] = [], 0
        for size in sizes:
            if waiting[size]:
                yield parcels(size, held[size])

    return source.select("text").mapInArrow(run, "size int, bucket int, h binary, n array<int>")


def gram_counts(source: DataFrame, model: Model, sizes: int | Sequence[int], lot: int = 0, lots: int = 1, buckets: int = 0) -> DataFrame:
    """(size, h, c): the n-grams of these lengths in a lot, of two words or more those that stand ``min_count`` times.

    Counts are added up inside each task before they are moved, and move as
    arrays: n-grams that stand once, most of all, never become rows.
    """
    sizes = [sizes] if isinstance(sizes, int) else list(sizes)

    def add(rows: pa.Table) -> pa.Table:
        size = rows.column("size")[0].as_py()
        h, _ = _unpacked(rows, "h", _U)
        by = np.argsort(h)
        h = h[by]
        first = _firsts(h)
        c = np.add.reduceat(pc.list_flatten(rows.column("n")).to_numpy()[by], first, dtype=np.int64)
        kept = c >= (model.min_count if size > 1 else 1)
        h, c = h[first[kept]].view(np.int64), c[kept]
        return pa.table([pa.array(np.full(len(h), size, np.int32)), pa.array(h), pa.array(c)], names=["size", "h", "c"])

    parcels = gram_parcels(source, sizes, lot, lots, buckets or _buckets())
    return parcels.groupBy("size", "bucket").applyInArrow(add, _COUNTS)


def gram_table(source: DataFrame, model: Model) -> tuple[int, int, DataFrame, DataFrame]:
    """The number of all words, the lots to look n-grams up in, and the counts of the n-grams in the table: (h, c) of
    the frequent ones, and the others as every lot reads them (``_count_parcels``).

    A single word that stands once is not listed: one that is not found stands once.
    """
    spark = source.sparkSession
    about = (source.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0) // 6  # words, which only lots and buckets follow
    lots = model.lots if about > model.whole else 1
    counted = max(1, lots // 2)
    paths = []
    for lot in range(counted):
        counts = gram_counts(source, model, range(1, model.order + 1), lot, counted, _buckets(about // counted))
        paths.append(frames.settled(counts, "lm-counts")[1])
    counts = spark.read.schema(_COUNTS).parquet(*paths)
    total = counts.where(F.col("size") == 1).agg(F.sum("c")).collect()[0][0] or 0
    table = counts.where((F.col("size") > 1) | (F.col("c") >= min(model.min_count, 2))).select("h", "c")
    lots += lots // 2
    frequent, rest = (table.where(x) for x in _parted(total, model))
    frequent = frames.settled(frequent, "lm-frequent")[0]
    rest = frames.settled(_count_parcels(rest, _meeting(total, model, lots)), "lm-table")[0]
    for path in paths:
        frames.remove(spark, path)
    return total, lots, frequent, rest


def _parted(total: int, model: Model) -> tuple[Column, Column]:
    """Frequent n-grams, at most ``frequent`` of each length, and the others."""
    limit = total / model.frequent
    return F.col("c") > limit, F.col("c") <= limit


def _meeting(total: int, model: Model, lots: int) -> int:
    """Groups in which the n-grams of a lot meet the table."""
    return _buckets(model.order * total // lots)


def _asked(source: DataFrame, frequent: pa.Table, model: Model, lot: int, lots: int, buckets: int) -> DataFrame:
    """The exploded n-grams of a lot of documents: those of a stretch of texts that meet in a bucket are a row.

    ``h`` has their hashes and ``at`` their places in the stretch, packed: word
    by word, and of the n-grams that end with a word the shorter ones first. One
    row a stretch has the keys of its rows, their words (``n``), of these the
    ones scored in the stretch before (``skip``), and for all places the number
    of the ``frequent`` n-gram that stands there, which is not asked for, or 0.
    """
    order = model.order
    known = np.sort(frequent.column("h").to_numpy())
    marks = np.zeros(1 << _MARKS, bool)
    marks[known.view(_U) >> _U(64 - _MARKS)] = True
    shared = source.sparkSession.sparkContext.broadcast((known, marks))

    def sent(stretch: int, parts: list[list[np.ndarray]], own: list[list[np.ndarray]]) -> pa.RecordBatch:
        h, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        bucket, columns, ends = _parcels(h, buckets, h=h, at=at)
        rows = len(bucket) + 1  # the last one is the stretch's own
        made = {"bucket": pa.concat_arrays([bucket, pa.array([(stretch + (stretch >> 32)) % buckets], pa.int32())]), "stretch": pa.array(np.full(rows, stretch))}
        made |= {name: _packed(x, np.append(ends, len(x))) for name, x in columns.items()}
        for name, x in zip(_OWN, (np.concatenate(x) for x in zip(*own, strict=True)), strict=True):
            made[name] = _packed(x, np.append(np.zeros(rows - 1, np.int64), len(x)))
        return pa.RecordBatch.from_pydict(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks = shared.value
        stretch = TaskContext.get().partitionId() << 32
        parts, own, waiting, words_held = [], [], 0, 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, words, n, skip in _pieces(batch.column(1), order):
                nth = _nth(n)
                there = np.zeros((len(words), order), np.int32)
                for size, h in _chained(words, order):
                    ends = np.flatnonzero(nth[size - 1 :] >= size - 1)  # none crosses a row
                    h = h[ends].view(np.int64)
                    if len(known):
                        likely = np.flatnonzero(marks[h.view(_U) >> _U(64 - _MARKS)])
                        found = np.minimum(np.searchsorted(known, h[likely]), len(known) - 1)
                        hit = known[found] == h[likely]
                        there[ends[likely[hit]] + size - 1, size - 1] = found[hit] + 1
                        asked = np.ones(len(h), bool)
                        asked[likely[hit]] = False
                        ends, h = ends[asked], h[asked]
                    at = ((ends + size - 1 + words_held) * order + size - 1).astype(np.int32)
                    parts.append([h.view(_U), at])
                    waiting += len(h)
                own.append([keys[first : first + len(n)], n, skip, there.reshape(-1)])
                words_held += len(words)
                if waiting >= _HELD or words_held >= _HELD:
                    yield sent(stretch, parts, own)
                    stretch += 1
                    parts, own, waiting, words_held = [], [], 0, 0
        if own:
            yield sent(stretch, parts, own)

    mine = source.where(F.pmod("key", F.lit(lots)) == lot) if lots > 1 else source
    return mine.select("key", "text").mapInArrow(run, _ASKED)


def _count_parcels(table: DataFrame, buckets: int) -> DataFrame:
    """(bucket, h, c): the rows of ``table``, packed."""

    def parcels(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        h, c = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in range(2))
        bucket, columns, ends = _parcels(h.view(_U), buckets, h=h, c=c)
        return pa.RecordBatch.from_pydict({"bucket": bucket} | {name: _packed(x, ends) for name, x in columns.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= _HELD:
                yield parcels(held)
                held, n = [], 0
        if n:
            yield parcels(held)

    return table.select("h", "c").mapInArrow(run, "bucket int, h binary, c binary")


def _scored(counts: np.ndarray, n: np.ndarray, skip: np.ndarray, total: int, model: Model) -> list[np.ndarray]:
    """The score of each row's words, how many these are, and for how many the longest n-gram that stands there was found.

    ``counts`` has a row for each word, with the counts of the n-grams that end with it, the shorter ones first; 0 if not in the table.
    """
    nth = _nth(n)
    top = np.minimum(nth, model.order - 1)  # steps back there are
    logs = np.maximum(counts, 1).astype(float)
    np.log(logs, out=logs)
    back = math.log(model.backoff)
    score = logs[:, 0] - math.log(max(total, 1)) + top * back
    for k in range(1, model.order):
        there = np.flatnonzero(counts[:, k])
        score[there] = logs[there, k] - logs[there - 1, k - 1] + (top[there] - k) * back
    hit = (top > 0) & (counts[np.arange(len(nth)), top] > 0)
    new = nth >= np.repeat(skip, n)
    row = np.repeat(np.arange(len(n)), n)[new]
    return [np.bincount(row, weights=score[new], minlength=len(n)).astype(float), (n - skip).astype(np.int64), np.bincount(row[hit[new]], minlength=len(n))]


def gram_sums(source: DataFrame, table: DataFrame, total: int, model: Model, lot: int, lots: int, packed: DataFrame | None = None) -> DataFrame:
    """(key, score, words, hits) of a lot of documents: the score of a document's words in a stretch of texts, how many
    they are, and for how many of them the longest n-gram that stands there is in the table.

    ``packed`` has what ``table`` has of n-grams that are not frequent, where it is packed already.
    """
    buckets, (often, seldom) = _meeting(total, model, lots), _parted(total, model)
    frequent = table.where(often).select("h", "c").toArrow().sort_by("h")
    shared = source.sparkSession.sparkContext.broadcast(np.concatenate([np.zeros(1, np.int64), frequent.column("c").to_numpy()]))
    own = ", ".join(f"{name} binary" for name in _OWN)

    def found(asked: pa.Table, rest: pa.Table) -> pa.Table:
        known, _ = _unpacked(rest, "h", np.int64)
        c, _ = _unpacked(rest, "c", np.int64)
        (h, sizes), (at, _) = _unpacked(asked, "h", np.int64), _unpacked(asked, "at", np.int32)
        hit = np.zeros(0, np.int64)
        if len(known):
            by = np.argsort(known)
            known, c = known[by], c[by]
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = np.flatnonzero(known[place] == h)
            c = c[place[hit]]
        ends = np.searchsorted(hit, np.cumsum(sizes))
        columns = {"stretch": asked.column("stretch"), "at": _packed(at[hit], ends), "c": _packed(c, ends)}
        return pa.table(columns | {name: asked.column(name) for name in _OWN})

    def added(rows: pa.Table) -> pa.Table:
        keys, n, skip, there = (_unpacked(rows, name, kind)[0] for name, kind in zip(_OWN, (np.int64, np.int32, np.int32, np.int32), strict=True))
        counts = shared.value[there]
        counts[_unpacked(rows, "at", np.int32)[0]] = _unpacked(rows, "c", np.int64)[0]
        sums = _scored(counts.reshape(-1, model.order), n, skip, total, model)
        return pa.table([pa.array(x) for x in (keys, *sums)], names=["key", "score", "words", "hits"])

    asked = _asked(source, frequent, model, lot, lots, buckets)
    rest = _count_parcels(table.where(seldom), buckets) if packed is None else packed
    met = asked.groupBy("bucket").cogroup(rest.groupBy("bucket")).applyInArrow(found, f"stretch long, at binary, c binary, {own}")
    return met.groupBy("stretch").applyInArrow(added, "key long, score double, words long, hits long")


def lm_scores(docs: DataFrame, model: Model = Model(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_backed_off, mean_log_score) for every row of ``docs``.

    A word scores count(n-gram) / count(context) for the longest n-gram ending
    with it that is in the table, times ``backoff`` for each shorter one tried;
    a single word scores count / all words. Counts are over all rows of
    ``docs``, whole texts, words being ``[^\\x20\\x09-\\x0D]+``; n-grams do not
    cross rows. mean_log_score is the mean natural logarithm over the document's
    words, to six decimals; n_backed_off counts words scored below the longest
    n-gram that stands before them.

    A null or empty text, or one without words, has no score (null). Repeated
    rows count as often as they stand, and each is answered. Ids may be null or
    repeat; an empty table gives an empty result. Other columns are not read.
    Words are known by 64-bit hashes, n-grams by hashes of these.

    N-grams of all lengths are counted by one grouping for each lot of hashes.
    The exploded n-grams of a lot of documents are then joined by hash to the
    table of counts, the counts go back to the stretch of texts that the n-grams
    stand in, and there every word is scored; scores are summed per document.
    Where every n-gram moves, Spark deals and groups buckets of hashes, and a
    row holds, packed, the n-grams that a stretch of texts has in a bucket;
    buckets grow in number with the words. A pass that counts reads all texts, a
    pass that looks up hashes the texts of its lot; lots keep the disk within a
    part of the n-grams.
    A frequent n-gram never meets in one task: counts are added up before the
    shuffle, and its places take their count where they are read. What is left
    of any n-gram is at most one in ``frequent`` of all words.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    source = source.select("doc_id", frames.row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    total, lots, table, packed = gram_table(source, model)
    parts = [frames.settled(gram_sums(source, table, total, model, lot, lots, packed), "lm-sums")[0] for lot in range(lots)]
    sums = reduce(DataFrame.unionByName, parts).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("score", "words", "hits")])
    per_row = source.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("copies")).join(sums, "key", "left")
    n = F.expr("words div copies")
    longer = F.greatest(n - 1, F.lit(0)) if model.order > 1 else F.lit(0)
    per_row = per_row.select(
        "doc_id",
        "copies",
        n.alias("words"),
        (longer - F.expr("hits div copies")).cast("long").alias("backed"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
    per_row = frames.settled(per_row, "lm-rows")[0]
    # Rows that are equal in id and text were summed together: each gets its part.
    per_row = per_row.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / _COPIES))).alias("_lot"))
    in_lot = F.least(F.lit(_COPIES), F.col("copies") - F.col("_lot") * _COPIES).cast("int")
    per_row = per_row.select("*", F.explode(F.sequence(F.lit(1), in_lot)))
    return per_row.select(
        "doc_id",
        F.col("words").alias("n_words"),
        F.col("backed").alias("n_backed_off"),
        F.when(F.col("words") > 0, F.round(F.col("score") / F.col("words"), 6)).alias("mean_log_score"),
    )
