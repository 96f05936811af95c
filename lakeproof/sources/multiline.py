"""Records of delimited text whose quoted fields may hold line breaks, read by many tasks.

Files are read as lines, in the splits of any text file. Where a record starts
follows from the quotes before it, so each split first tells what it does to
their parity; the splits' answers are put together in order, and then every
split knows whether its first line stands inside quotes. What a split cannot
finish, the end of a record that began before it and the start of one that goes
on after it, is joined in a small shuffle of at most two pieces for each split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeproof.session import materialise

# One row a split is broadcast, some 150 bytes. At 128 MB a split that is 128 TB of text.
MOST_SPLITS = 1_000_000

_PIECES = "record long, place long, whole boolean, first boolean, text binary"
_ARROW = pa.schema([("record", pa.int64()), ("place", pa.int64()), ("whole", pa.bool_()), ("first", pa.bool_()), ("text", pa.binary())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("place")]
    return lines.select("value", *at, F.monotonically_increasing_id().alias("line"))


def splits(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, inside, id, origin): whether each split starts inside quotes, and the split where the record open there began.

    One row a split, from one scan that counts quotes where the lines are.
    """
    odd = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = _lines(spark, path).select("file", "place", "line", odd.alias("quotes"))
    # Where a split starts inside quotes, a record starts in it after its first odd line, unless that is its last.
    told = counted.groupBy("file", "place").agg(
        F.pmod(F.sum("quotes"), F.lit(2)).alias("odd"),
        (F.min(F.when(F.col("quotes") % 2 == 1, F.col("line"))) < F.max("line")).alias("turns"),
    )
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    known = told.withColumn("inside", F.coalesce(F.sum("odd").over(before) % 2 == 1, F.lit(False)))
    numbered = materialise(known.withColumn("id", F.monotonically_increasing_id()), "splits")
    starts = F.when(~F.col("inside") | F.coalesce("turns", F.lit(False)), F.col("id"))
    return numbered.select("file", "place", "inside", "id", F.last(starts, ignorenulls=True).over(before).alias("origin"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (text, id, place, inside, origin) of whole splits in order to records and pieces of records."""
    split: tuple | None = None  # the split at hand: id, place, origin
    pending: list[bytes] = []  # lines of the record that is open
    inherited = first = False  # whether it began in an earlier split; whether it is the file's first
    inside = 0

    def piece(record: int, place: int, whole: bool, text: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((record, place, whole, first, text), _ARROW, strict=True)], schema=_ARROW)

    def rest() -> Iterator[pa.RecordBatch]:
        if split is not None and pending:
            yield piece(split[2] if inherited else split[0], split[1], False, b"\n".join(pending))

    for batch in batches:
        ids = batch.column(1).to_numpy()
        edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if split is None or split[0] != ids[a]:
                yield from rest()
                _, place, starts_inside, origin = (batch.column(c)[a].as_py() for c in range(1, 5))
                split, pending = (int(ids[a]), place, origin), []
                inside, inherited, first = int(starts_inside), starts_inside, place == 0
            text = batch.column(0).slice(a, b - a)
            after = (inside + np.cumsum(pc.count_substring(text, '"').to_numpy())) % 2
            inside = int(after[-1])
            ends = np.flatnonzero(after == 0) + 1
            if not len(ends):
                pending += text.to_pylist()
                continue
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), text)
            joined = pc.binary_join(lists, pa.scalar(b"\n"))
            done = 0
            if pending or inherited or first:
                head = b"\n".join([*pending, joined[0].as_py()])
                yield piece(split[2] if inherited else split[0], split[1], not inherited, head)
                pending, inherited, first, done = [], False, False, 1
            n = len(joined) - done
            columns = [np.full(n, split[0]), np.full(n, split[1]), np.ones(n, bool), np.zeros(n, bool)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), joined.slice(done)], schema=_ARROW)
            pending = text.slice(int(ends[-1])).to_pylist()
    yield from rest()


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): every record as text, line breaks inside it kept, and whether it is its file's first.

    Lines end with a line feed or with carriage return and line feed; empty ones
    between records are dropped. A quote stands in quoted fields only, doubled.
    A compressed file is one split, as it always is.
    """
    of = splits(spark, path)
    n = of.count()
    if n > MOST_SPLITS:
        raise ValueError(f"{n} splits are too many to broadcast; raise spark.sql.files.maxPartitionBytes")
    known = F.broadcast(of.toDF("_file", "_place", "inside", "id", "origin"))
    lines = _lines(spark, path).join(known, (F.col("file") == F.col("_file")) & (F.col("place") == F.col("_place")))
    pieces = lines.select(F.col("value").cast("binary").alias("text"), "id", "place", "inside", "origin").mapInArrow(_cut, _PIECES)
    pieces = pieces.withColumn("text", F.col("text").cast("string"))
    whole = pieces.where("whole").select("text", "first")
    parts = F.array_sort(F.collect_list(F.struct("place", "text")))  # of one record, which is one row in the end
    joined = pieces.where("NOT whole").groupBy("record").agg(parts.alias("parts"), F.bool_or("first").alias("first"))
    joined = joined.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"), "first")
    every = whole.unionByName(joined)
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, char_length(text) - 1)")).otherwise(F.col("text"))
    return every.select(text.alias("record"), "first").where("record <> ''")
