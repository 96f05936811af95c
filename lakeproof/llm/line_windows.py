"""Line dedup by overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeproof.llm import frames

WINDOW = 3
_BLANK = r"[ \t\x0B\f\r]+"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _is_line(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\x0b\x0c\r")) != ""


def line_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated windows of lines removed, plus n_lines and n_removed.

    Lines are what stands between line feeds; blank lines are not counted, never
    removed, and windows reach across them. A window is ``window`` consecutive
    lines of one document, compared as they are written. The first occurrence
    of a window, by document id (null first), then the row's key, then
    position, stays; every line of a later occurrence is removed, overlapping
    occurrences together. Windows are judged on the input, so a line that is
    removed still counts in the windows around it.

    A null or empty text has no lines and stays as it is; a text of fewer lines
    than ``window`` has no window. Rows with equal id and text count as one
    document. All other columns of ``docs`` are kept as they are, but n_lines and
    n_removed replace columns of these names; an empty table gives an empty result.

    Only hashes (128 bits) travel until the end: a window that is everywhere is
    one row for each task before the shuffle, later occurrences are joined back
    with a side that AQE can split, and the texts move once.
    """
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{text_col}`").alias("_text"),
    ).withColumn("_key", frames.row_key(F.col("_id"), F.col("_text")))

    # Positions count lines that are not blank, so a removed position names a line of the text.
    kept = F.filter(_lines(F.col("_text")), _is_line)
    hashed = F.transform(
        F.array(kept),
        lambda lines: F.when(
            F.size(lines) >= window,
            F.transform(
                F.sequence(F.lit(0), F.size(lines) - window),
                lambda i: F.struct(
                    F.xxhash64(*[F.get(lines, i + k) for k in range(window)]).alias("h1"),
                    F.xxhash64(F.lit(1), *[F.get(lines, i + k) for k in range(window)]).alias("h2"),
                    i.alias("at"),
                ),
            ),
        ),
    )[0]
    windows = source.select("_id", "_key", F.inline(hashed))
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_key", "at")).alias("first"))
        .where(F.col("n") > 1)
    )
    later = (
        windows.join(first, ["h1", "h2"])
        .where(~F.struct("_id", "_key", "at").eqNullSafe(F.col("first")))
        .groupBy("_id", "_key")
        .agg(F.collect_set("at").alias("at"))
        .select(F.col("_id").alias("_id2"), F.col("_key").alias("_key2"), F.array_sort("at").alias("_at"))
    )
    joined = source.join(later, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left")

    # Merge the covered positions: a line goes if a removed window starts at most window - 1 before it.
    covered = F.array_distinct(
        F.flatten(F.transform(F.col("_at"), lambda p: F.transform(F.sequence(F.lit(0), F.lit(window - 1)), lambda k: p + k)))
    )
    merged = joined.select("_row", "_text", covered.alias("_gone"))
    row = [
        F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(_remaining(F.col("_text"), F.col("_gone"))).alias(text_col)
        if c == text_col
        else F.col("_row").getField(c).alias(c)
        for c in docs.columns
        if c not in ("n_lines", "n_removed")
    ]
    return merged.select(
        *row,
        F.size(F.filter(_lines(F.col("_text")), _is_line)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def _remaining(text: Column, gone: Column) -> Column:
    """The text without its lines of the numbers ``gone``, blank lines not numbered; linear in the lines."""

    def rest(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        removed = F.transform(
            F.array(F.filter(every, lambda i: _is_line(F.get(lines, i)))),
            lambda numbered: F.transform(gone, lambda p: F.get(numbered, p)),
        )[0]
        return F.transform(F.array_except(every, removed), lambda i: F.get(lines, i))

    return F.array_join(F.transform(F.array(_lines(text)), rest)[0], "\n")
