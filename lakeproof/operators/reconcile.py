"""Two sides of the same table: profiles compared, rows compared."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lakeproof.functions.sqltext import name
from lakeproof.session import materialise

_AT = ["table_name", "column_name", "metric"]


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Long profiles side by side; either side may lack a measurement."""
    a = left.select(*_AT, F.col("value").alias("left_value"))
    b = right.select(*_AT, F.col("value").alias("right_value"))
    return a.join(b, _AT, "full_outer")


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    return reconcile(left, right).where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows of each group.

    Spark keeps n rows per group in every task before the shuffle, so a group
    with most of the rows does not end up whole in one task.
    """
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_n") <= n).drop("_n")


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], as_: str) -> DataFrame:
    """Rows numbered from 1 within their group; a group of any size is dealt over many tasks.

    Rows are sorted into ranges of group and order, and the ranges written, so
    that a row keeps its range. Each range is numbered on its own, and the rows
    of the group in the ranges before it are added: one small row per group and
    range. ``order`` must tell the rows of a group apart.
    """
    ranged = df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    sizes = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_size"))
    # Only groups that reach into several ranges have anything to add.
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.sum("_size").over(earlier)).where("_before > 0")
    before = before.select(*[F.col(name(c)).alias(f"_of_{c}") for c in group], F.col("_range").alias("_of_range"), "_before")
    same = reduce(and_, (F.col(name(c)).eqNullSafe(F.col(name(f"_of_{c}"))) for c in group))
    local = F.row_number().over(Window.partitionBy(*group, "_range").orderBy(*order))
    with_local = ranged.withColumn("_local", local).join(before, same & (F.col("_range") == F.col("_of_range")), "left")
    return with_local.select(*df.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).alias(as_))


def row_differences(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key columns, l, r): the cells of rows the two sides do not share.

    Equal rows cancel out in one aggregation over keys and 128 bits of hash, so
    a key that repeats does not multiply and no row is shuffled whole. What is
    left is written to the scratch folder, fetches its cells, and is paired per
    key in the order of the cells: the first with the first, and so on. A side
    with fewer rows for the key has NULL there. A key with most of the differing
    rows is numbered by many tasks.
    """
    cells = [c for c in left.columns if c not in key]
    # Hashes skip NULLs, so each is told; nested values, whose own NULLs cannot be told, are compared as they are.
    nested = [c for c in cells if isinstance(left.schema[c].dataType, (T.ArrayType, T.StructType))]
    told = [x for c in cells if c not in nested for x in (F.col(name(c)).isNull(), F.col(name(c)))]
    both = left.select(*key, *cells, F.lit(1).alias("_side")).unionAll(right.select(*key, *cells, F.lit(-1).alias("_side")))
    hashes = [F.xxhash64(F.lit(k), *told).alias(f"_hash{k}") for k in range(2)]
    by = [*key, *nested, "_hash0", "_hash1"]
    rows = both.select(*key, *nested, *hashes, "_side", F.struct(*cells).alias("_cells"))
    surplus = rows.groupBy(*by).agg(F.sum("_side").alias("_surplus")).where("_surplus <> 0")
    surplus = materialise(surplus, "row-differences").toDF(*[f"_of_{c}" for c in by], "_surplus")
    same = reduce(and_, (F.col(name(c)).eqNullSafe(F.col(name(f"_of_{c}"))) for c in by))
    left_over = rows.join(surplus, same).where("signum(_side) = signum(_surplus)")
    found = left_over.groupBy(*by).agg(F.first("_cells").alias("_cells"), F.first("_surplus").alias("_surplus"))
    each = found.select(*key, "_cells", (F.col("_surplus") > 0).alias("_left"), F.explode(F.sequence(F.lit(1), F.abs("_surplus"))).alias("_copy"))
    return (
        numbered(each, [*key, "_left"], ["_cells", "_copy"], "_nth")
        .groupBy(*key, "_nth")
        .agg(F.min(F.when(F.col("_left"), F.col("_cells"))).alias("l"), F.min(F.when(~F.col("_left"), F.col("_cells"))).alias("r"))
        .drop("_nth")
    )


def cell_differences(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key columns, column_name, left_value, right_value) for each differing cell.

    Rows meet on their key, as files have no stable order; a row that only one
    side has shows up under ``(row)``. Only differing cells leave the row.
    """
    paired = row_differences(left, right, key)
    here, there = F.col("l").isNotNull(), F.col("r").isNotNull()

    def cell(name: str, l: Column, r: Column, differs: Column) -> Column:
        return F.when(differs, F.struct(F.lit(name).alias("column_name"), l.alias("left_value"), r.alias("right_value")))

    presence = cell(
        "(row)",
        F.when(here, F.lit("present")).otherwise("absent"),
        F.when(there, F.lit("present")).otherwise("absent"),
        ~(here & there),
    )
    compared = [
        cell(
            c,
            F.col(f"l.`{c}`").cast("string"),
            F.col(f"r.`{c}`").cast("string"),
            here & there & ~F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")),
        )
        for c in left.columns
        if c not in key
    ]
    return paired.select(*key, F.inline(F.array_compact(F.array(presence, *compared))))


def diff_sample(left: DataFrame, right: DataFrame, key: Sequence[str], n: int = 2) -> DataFrame:
    """The first n differing cells of every column, in key order."""
    return first_per_group(cell_differences(left, right, key), ["column_name"], list(key), n)
