"""Relationships between tables: derived from names, declared, curated, compared.

Edges are rows ``(from_table, from_columns, to_table, to_columns)`` with column
lists, so a composite key stays one edge. All of this is metadata: its size is
the number of columns, not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeproof.operators.keys import Edge
from lakeproof.session import local_frame

EDGE = ["from_table", "from_columns", "to_table", "to_columns"]
EDGE_SCHEMA = "from_table string, from_columns array<string>, to_table string, to_columns array<string>"

# Fixed values of the naming convention.
DIMENSION, FACT = "dim_", "fact_"
PARENT, KEY, ALTERNATE, DATE = "parent_", "_key", "_alternate_key", "_date"
DATE_TABLE, DATE_KEY = "dim_date", "date_key"


def edge_frame(spark: SparkSession, edges: Sequence[Edge]) -> DataFrame:
    return local_frame(spark, [(f, list(fc), t, list(tc)) for f, fc, t, tc in edges], EDGE_SCHEMA)


def edge_list(edges: DataFrame) -> list[Edge]:
    """Edges on the driver, ordered; one row per relationship."""
    rows = edges.select(*EDGE).distinct().collect()
    return sorted((r.from_table, tuple(r.from_columns), r.to_table, tuple(r.to_columns)) for r in rows)


def spelled() -> Column:
    """dim_a.x+y -> dim_b.x+y."""
    return F.concat(
        "from_table", F.lit("."), F.concat_ws("+", "from_columns"), F.lit(" -> "),
        "to_table", F.lit("."), F.concat_ws("+", "to_columns"),
    )


def own_key(table: Column) -> Column:
    """dim_customer -> customer_key."""
    return F.concat(F.regexp_replace(table, f"^({DIMENSION}|{FACT})", ""), F.lit(KEY))


def primary_keys(catalog: DataFrame) -> DataFrame:
    """(table_name, column_name): the tables that hold their own surrogate key."""
    return catalog.where(F.col("column_name") == own_key(F.col("table_name"))).select("table_name", "column_name")


def classify_keys(catalog: DataFrame) -> DataFrame:
    """Every ``*_key`` column with its kind and, where it refers, its target.

    The rules apply in this order: a parent key is a hierarchy even when it is
    an alternate key too; alternate keys and the table's own key refer to
    nothing; a key named after a dimension refers to it; a date key plays a
    role of the date dimension; a fact may carry a key of its own. What no rule
    places is ``unclassified``.
    """
    name, table = F.col("column_name"), F.col("table_name")
    keys = catalog.where(name.endswith(KEY)).select("table_name", "column_name")
    stem = F.regexp_replace(name, f"{KEY}$", "")
    bare = F.regexp_replace(name, f"^{PARENT}", "")
    dimensions = catalog.select(F.col("table_name").alias("dimension")).distinct()
    has_dates = dimensions.where(F.col("dimension") == DATE_TABLE).select(F.col("dimension").alias("dates"))
    siblings = catalog.select("table_name", F.col("column_name").alias("sibling"))

    placed = (
        keys.withColumn("stem", stem)
        .withColumn("bare", bare)
        .withColumn("wanted", F.concat(F.lit(DIMENSION), "stem"))
        .withColumn("calendar", F.when(F.col("stem").endswith(DATE), F.lit(DATE_TABLE)))
    )
    placed = (
        placed.join(dimensions, F.col("wanted") == F.col("dimension"), "left")
        .join(has_dates, F.col("calendar") == F.col("dates"), "left")
        .join(
            siblings.withColumnRenamed("table_name", "home"),
            (table == F.col("home")) & (F.col("bare") == F.col("sibling")),
            "left",
        )
    )
    kind = (
        F.when(name.startswith(PARENT), "hierarchy")
        .when(name.endswith(ALTERNATE), "natural key")
        .when(name == own_key(table), "own key")
        .when(F.col("dimension").isNotNull() & (F.col("dimension") != table), "dimension")
        .when(F.col("dates").isNotNull(), "date role")
        .when(table == F.concat(F.lit(FACT), "stem"), "degenerate")
        .otherwise("unclassified")
    )
    target = (
        F.when(F.col("kind") == "hierarchy", table)
        .when(F.col("kind") == "dimension", F.col("wanted"))
        .when(F.col("kind") == "date role", F.lit(DATE_TABLE))
    )
    target_key = (
        F.when(F.col("kind") == "hierarchy", F.coalesce("sibling", own_key(table)))
        .when(F.col("kind") == "dimension", own_key(F.col("wanted")))
        .when(F.col("kind") == "date role", F.lit(DATE_KEY))
    )
    return placed.withColumn("kind", kind).select(
        "table_name", "column_name", "kind", target.alias("to_table"), target_key.alias("to_column")
    )


def _as_edges(classified: DataFrame) -> DataFrame:
    return classified.select(
        F.col("table_name").alias("from_table"),
        F.array("column_name").alias("from_columns"),
        "to_table",
        F.array("to_column").alias("to_columns"),
    )


def derived_edges(classified: DataFrame) -> DataFrame:
    return _as_edges(classified.where(F.col("kind").isin("dimension", "date role")))


def hierarchy_edges(classified: DataFrame) -> DataFrame:
    return _as_edges(classified.where(F.col("kind") == "hierarchy"))


def edge_union(*sets: DataFrame) -> DataFrame:
    out = sets[0].select(*EDGE)
    for s in sets[1:]:
        out = out.unionAll(s.select(*EDGE))
    return out.distinct()


def edge_diff(declared: DataFrame, derived: DataFrame, hierarchies: DataFrame) -> DataFrame:
    """Each edge with its verdict: agreed, routed, missed or invented."""
    tagged = (
        declared.select(*EDGE, F.lit("declared").alias("origin"))
        .unionAll(derived.select(*EDGE, F.lit("derived").alias("origin")))
        .unionAll(hierarchies.select(*EDGE, F.lit("hierarchy").alias("origin")))
    )
    seen = tagged.groupBy(*EDGE).agg(
        F.bool_or(F.col("origin") == "declared").alias("is_declared"),
        F.bool_or(F.col("origin") == "derived").alias("is_derived"),
        F.bool_or(F.col("origin") == "hierarchy").alias("is_hierarchy"),
    )
    verdict = (
        F.when(F.col("is_declared") & F.col("is_derived"), "agreed")
        .when(F.col("is_declared") & F.col("is_hierarchy"), "routed")
        .when(F.col("is_declared"), "missed")
        .when(F.col("is_derived"), "invented")
    )
    return seen.withColumn("verdict", verdict).where(F.col("verdict").isNotNull()).select(*EDGE, "verdict")


def canonical(edges: DataFrame) -> DataFrame:
    """The same relationship always spelled the same: column pairs sorted together."""
    pairs = F.array_sort(F.arrays_zip(F.col("from_columns").alias("f"), F.col("to_columns").alias("t")))
    return edges.withColumn("_pairs", pairs).select(
        *[F.col(c) for c in edges.columns if c not in ("from_columns", "to_columns")],
        F.transform("_pairs", lambda p: p["f"]).alias("from_columns"),
        F.transform("_pairs", lambda p: p["t"]).alias("to_columns"),
    )


def not_minimal(curated: DataFrame, *covered_by: DataFrame) -> DataFrame:
    """Curated edges that should not be there, canonically spelled, with the reason.

    ``duplicate``: listed twice. ``covered``: some other source already knows
    the relationship, in whatever column order.
    """
    listed = canonical(curated.select(*EDGE)).select(*EDGE)
    repeated = listed.groupBy(*EDGE).count().where("count > 1").select(*EDGE, F.lit("duplicate").alias("reason"))
    known = canonical(edge_union(*covered_by))
    covered = listed.distinct().join(known, EDGE, "left_semi").select(*EDGE, F.lit("covered").alias("reason"))
    return repeated.unionAll(covered)


def broken_structure(edges: DataFrame, catalog: DataFrame) -> DataFrame:
    """(edge, table_name, column_name) for every table or column an edge lacks.

    ``column_name`` is NULL when the whole table is missing.
    """
    ends = edges.select(
        spelled().alias("edge"),
        F.explode(
            F.array_union(
                F.transform("from_columns", lambda c: F.struct(F.col("from_table").alias("t"), c.alias("c"))),
                F.transform("to_columns", lambda c: F.struct(F.col("to_table").alias("t"), c.alias("c"))),
            )
        ).alias("end"),
    ).select("edge", F.col("end.t").alias("table_name"), F.col("end.c").alias("column_name"))
    tables = catalog.select("table_name").distinct()
    no_table = ends.join(tables, "table_name", "left_anti").select(
        "edge", "table_name", F.lit(None).cast("string").alias("column_name")
    )
    no_column = (
        ends.join(tables, "table_name", "left_semi")
        .join(catalog.select("table_name", "column_name"), ["table_name", "column_name"], "left_anti")
        .select("edge", "table_name", "column_name")
    )
    return no_table.distinct().unionAll(no_column)


def type_coverage(golden: DataFrame, catalog: DataFrame) -> DataFrame:
    """(sql_type, finding): types in use that no case pins, cases no column uses."""
    pinned, used = golden.select("sql_type").distinct(), catalog.select("sql_type").distinct()
    return used.subtract(pinned).select("sql_type", F.lit("unpinned").alias("finding")).unionAll(
        pinned.subtract(used).select("sql_type", F.lit("unexercised").alias("finding"))
    )


def edge_totals(edges: DataFrame) -> DataFrame:
    """(constraints, composites) over distinct edges."""
    return edges.select(*EDGE).distinct().agg(
        F.count(F.lit(1)).alias("constraints"), F.count_if(F.size("from_columns") > 1).alias("composites")
    )
