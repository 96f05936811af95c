"""Removal of byte strings that occur twice, by radix passes over sampled suffixes.

A suffix array would order every suffix of the corpus; only groups of suffixes
that agree through the threshold length matter here. The passes below are those
of a most-significant-digit radix sort that stops at this depth, with two
changes that make it fit a cluster:

* Suffixes are taken at anchors only (``suffixes.anchors``), about one in
  seventy bytes. Equal windows have equal anchors at equal places, so no
  repeated window is missed, and each anchor stands for a run of windows.
* A digit is the hash of a stretch of bytes, and a group that one member is left
  in is dropped at once, as singletons are in a radix sort.

The first digit is the anchor's own bytes. The second is the hull, all bytes
that the anchor's windows cover: where a group agrees on it, all its windows are
repeated and the group is finished, and copies of whole passages end here. In
the groups that are left (borders of passages, edits), later digits descend to
runs of 25, then 5, then single windows, each time dropping what is unique,
finishing what agrees, and passing on the rest; at the last digit equal groups
are exactly the repeated windows. Equality means 128 equal hash bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeproof.llm import arrays, frames, suffixes
from lakeproof.llm.suffixes import Shape

WIDTHS = (25, 5, 1)
_ID = ("doc_id", "key")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(source: DataFrame, shape: Shape, where: bool) -> DataFrame:
    """(h, g) for every anchor; with ``where``, also its document, place and first and last window."""
    schema = frames.plus(source.select(*_ID).schema, "place int, lo short, hi short, h long, g long")
    arrow = frames.arrow_schema(schema)
    if not where:
        schema, arrow = schema.__class__(schema.fields[-2:]), pa.schema(list(arrow)[-2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_buffer(batch.column(2))
            for row, base, begin, end in suffixes.slices(offsets, shape.length):
                own, place, first, last, h, g = suffixes.anchors(data, begin, end, shape)
                found = [_signed(h), _signed(g)]
                if where:
                    at = pa.array(row[own])
                    distance = [pa.array((place - x).astype(np.int16)) for x in (last, first)]
                    found = [*(batch.column(k).take(at) for k in (0, 1)), pa.array((base[own] + place).astype(np.int32)), *distance, *found]
                yield pa.RecordBatch.from_arrays(found, schema=arrow)

    return source.mapInArrow(run, schema)


def _contexts(docs: DataFrame, shape: Shape) -> DataFrame:
    """The bytes of the hull of each (place, lo, hi, h, g, n) listed with a document."""
    schema = "h long, g long, n long, lo short, hi short, hull binary"
    arrow = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("lo", pa.int16()), ("hi", pa.int16()), ("hull", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_buffer(batch.column(0))
            listed = batch.column(1)
            counts = np.diff(listed.offsets.to_numpy())
            flat = listed.flatten()
            place, lo, hi = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            start = np.repeat(offsets[:-1], counts) + place - hi
            raw = data.tobytes()
            size = shape.length + hi - lo
            hulls = [raw[a : a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([flat.field(3), flat.field(4), flat.field(5), flat.field(1), flat.field(2), pa.array(hulls, pa.binary())], schema=arrow)

    return docs.mapInArrow(run, schema)


def _digits(classes: DataFrame, shape: Shape, width: int) -> DataFrame:
    """The digits of every class at runs of ``width`` windows.

    A run is an aligned range of distances between window start and anchor.
    ``core`` hashes what all windows of the run share, ``hull`` what the class's
    windows in the run cover. ``runs`` limits a class to parts of it.
    """
    schema = "h long, g long, n long, lo short, hi short, core long, hull long"
    arrow = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("lo", pa.int16()), ("hi", pa.int16()), ("core", pa.int64()), ("hull", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hulls = batch.column(4).cast(pa.large_binary())
            offsets = np.frombuffer(hulls.buffers()[1], np.int64)[hulls.offset : hulls.offset + len(hulls) + 1]
            data = np.frombuffer(hulls.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            top = batch.column(3).to_numpy().astype(np.int64)  # distance of the hull's begin from the anchor
            listed = batch.column(5)
            counts = np.diff(listed.offsets.to_numpy())
            owner = np.repeat(np.arange(len(hulls)), counts)
            low, high = (listed.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            # Cut the ranges at multiples of the width.
            pieces = high // width - low // width + 1
            owner, low, high = (np.repeat(x, pieces) for x in (owner, low, high))
            run_no = low // width + np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lo, hi = np.maximum(low, run_no * width), np.minimum(high, run_no * width + width - 1)
            for i, j in arrays.blocks(offsets):
                mine = slice(*np.searchsorted(owner, [i, j]))
                part = data[offsets[i] : offsets[j]]
                anchor = offsets[owner[mine]] - offsets[i] + top[owner[mine]]
                a, b, k = lo[mine], hi[mine], run_no[mine]
                kernel = np.minimum(k * width + width - 1, shape.reach - 1)
                core = arrays.window_hash(arrays.prefix_hash(part), anchor - k * width, anchor + shape.length - kernel)
                hull = arrays.window_hash(arrays.prefix_hash(part, 1), anchor - b, anchor - a + shape.length, 1)
                with np.errstate(over="ignore"):
                    core = arrays.mix(core + (k.astype(np.uint64) << np.uint64(8)) + np.uint64(width))
                    hull = arrays.mix(hull + (a * 1024 + b).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                at = pa.array(owner[mine])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in (0, 1, 2)), pa.array(a.astype(np.int16)), pa.array(b.astype(np.int16)), _signed(core), _signed(hull)],
                    schema=arrow,
                )

    return classes.select("h", "g", "n", "hi", "hull", "runs").mapInArrow(run, schema)


def _descend(classes: DataFrame, shape: Shape, widths: tuple[int, ...]) -> DataFrame:
    """(h, g, lo, hi): runs of repeated windows of the classes with one member."""
    found = []
    todo = classes.withColumn("runs", F.array(F.struct("lo", "hi")))
    for depth, width in enumerate(widths):
        rows = frames.step(_digits(todo, shape, width), f"repeats-digits-{width}")
        if depth == len(widths) - 1:
            equal = rows.groupBy("core", "hull").agg(F.sum("n").alias("_n")).where("_n > 1").select(
                F.col("core").alias("_core"), F.col("hull").alias("_hull")
            )
            last = rows.where("n = 1").join(equal, (F.col("core") == F.col("_core")) & (F.col("hull") == F.col("_hull")))
            found.append(last.select("h", "g", "lo", "hi"))
            break
        groups = (
            rows.groupBy("core")
            .agg(F.sum("n").alias("_n"), F.min("hull").alias("_low"), F.max("hull").alias("_high"))
            .where("_n > 1")
            .select(F.col("core").alias("_core"), (F.col("_low") == F.col("_high")).alias("agree"))
        )
        shared = frames.step(rows.join(groups, F.col("core") == F.col("_core")).select("h", "g", "n", "lo", "hi", "agree"), "repeats-shared")
        found.append(shared.where("agree and n = 1").select("h", "g", "lo", "hi"))
        open_ = shared.where("not agree").groupBy("h", "g").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
        open_ = open_.select(F.col("h").alias("_h"), F.col("g").alias("_g"), "runs")
        todo = classes.join(open_, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g"))).drop("_h", "_g")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def repeated_spans(source: DataFrame, shape: Shape = Shape(), widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(doc_id, key, spans): byte ranges of each document that repeated windows cover; ranges may overlap."""
    # First digit: the anchor. Whether its group also agrees on the hull is told by the hulls' least and greatest hash.
    groups = (
        _anchor_rows(source, shape, where=False)
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("g").alias("_low"), F.max("g").alias("_high"))
        .where("_n > 1")
        .select(F.col("h").alias("_h"), (F.col("_low") == F.col("_high")).alias("agree"))
    )
    members = _anchor_rows(source, shape, where=True)
    hits = frames.step(members.join(groups, F.col("h") == F.col("_h")).drop("_h"), "repeats-hits")

    # Second digit: the hull. Classes are the members of a group with the same hull.
    mixed = hits.where("not agree")
    classes = (
        mixed.groupBy("h", "g")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_ID, "place", "lo", "hi")).alias("at"))
        .select("h", "g", "n", "at.*")
    )
    classes = frames.step(classes, "repeats-classes")
    several = classes.where("n > 1").select(F.col("h").alias("_h"), F.col("g").alias("_g"))
    copies = mixed.join(several, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")), "left_semi")

    # Later digits, from the bytes around one member of each class.
    listed = classes.groupBy(*[F.col(c).alias(f"_{c}") for c in _ID]).agg(
        F.collect_list(F.struct("place", "lo", "hi", "h", "g", "n")).alias("listed")
    )
    texts = source.join(listed, frames.same(("doc_id", "_doc_id"), ("key", "_key"))).select("text", "listed")
    contexts = frames.step(_contexts(texts, shape), "repeats-contexts")
    runs = _descend(contexts, shape, widths).select(F.col("h").alias("_h"), F.col("g").alias("_g"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    single = classes.join(runs, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")))

    span = lambda lo, hi: F.struct((F.col("place") - F.col(hi)).alias("start"), (F.col("place") - F.col(lo) + shape.length).alias("end"))
    spans = (
        hits.where("agree").select(*_ID, span("lo", "hi").alias("span"))
        .unionByName(copies.select(*_ID, span("lo", "hi").alias("span")))
        .unionByName(single.select(*_ID, span("_lo", "_hi").alias("span")))
    )
    return frames.step(spans.groupBy(*_ID).agg(F.collect_list("span").alias("spans")), "repeats-spans")


def remove_repeats(
    docs: DataFrame, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text", widths: tuple[int, ...] = WIDTHS
) -> DataFrame:
    """What is left of every text when all bytes of repeated strings are taken out.

    A byte goes if some string of ``shape.length`` bytes that covers it also
    starts anywhere else in the corpus, in the same document or another; strings
    are judged on the input and never cross documents. Returns, for each row of
    ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256, spans (begin and end of each run, in bytes) and kept (the
    remaining bytes, which need not be valid UTF-8).

    A null text is empty. Equal rows are copies of each other, so their common
    strings go from all of them. Ids may be null or repeat. Texts shorter than a
    string stay whole; texts of any length are read whole, in overlapping
    stretches. An empty table gives an empty result. Other columns are not read.

    No group is ever gathered: groups are counted with map-side combining, and
    members are joined back to their group, sides that AQE can split. Each pass
    is written to the shared folder and its shuffle files are given up.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    source = source.select("doc_id", frames.row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    spans = repeated_spans(source, shape, widths).select(*[F.col(c).alias(f"_{c}") for c in _ID], "spans")
    joined = source.join(spans, frames.same(("doc_id", "_doc_id"), ("key", "_key")), "left").select("doc_id", "text", "spans")
    schema = frames.plus(
        joined.select("doc_id").schema,
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary",
    )
    arrow = frames.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column(1), []
            for text, ranges in zip(texts, batch.column(2), strict=True):
                raw = text.as_buffer().to_pybytes()
                runs = merge(ranges) if ranges.is_valid else []
                kept, at = [], 0
                for a, b in runs:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                listed = [{"start": a, "end": b} for a, b in runs]
                rows.append((len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest(), listed, left))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [f.type for f in arrow][1:]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], schema=arrow)

    return joined.mapInArrow(run, schema)


def merge(ranges: pa.Scalar) -> list[tuple[int, int]]:
    """Maximal runs covered by ranges that may overlap or touch."""
    flat = ranges.values
    start, end = flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    begins = np.append(True, start[1:] > end[:-1])
    return list(zip(start[begins].tolist(), end[np.append(begins[1:], True)].tolist(), strict=True))
