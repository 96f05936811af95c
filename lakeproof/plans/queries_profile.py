"""Queries: counts, sums, profiles, digests, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.functions import text
from lakeproof.operators import joins, profile, reconcile
from lakeproof.operators.profile import union_all
from lakeproof.plans import planted, star
from lakeproof.plans.queries_ingest import MD5_SQL, hashable, hashable_sql
from lakeproof.plans.registry import over, query, rows_sql, values_sql
from lakeproof.session import local_frame, settle_all
from lakeproof.sources import specs

_ORDER_EDGE = star.DECLARED[6]


@query(
    "grouped_totals",
    over(
        "fact_lineitem",
        "dim_order",
        body="SELECT order_status, count(*) AS n, CAST(sum(extended_price) AS DECIMAL(38,4)) AS total "
        "FROM fact_lineitem JOIN dim_order USING (order_key) GROUP BY order_status ORDER BY order_status",
    ),
)
def grouped_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and money by order status; lines are summed per order before the join."""
    lines = star.frame(spark, sf_dir, "fact_lineitem")
    per_order = joins.subtotals(lines, ["order_key"], F.col("extended_price"))
    orders = star.frame(spark, sf_dir, "dim_order")
    joined = joins.follow(per_order, orders, _ORDER_EDGE, {"order_status": "order_status"})
    return joins.totals(joined, ["order_status"])


@query(
    "row_count",
    over(*star.TABLES, body=rows_sql([f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in star.TABLES])),
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_counts(star.frames(spark, sf_dir))


def kept_frame(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A star table without the columns that are never loaded."""
    return star.frame(spark, sf_dir, table).select(*[c.name for c in star.SPECS[table].kept])


def kept_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: kept_frame(spark, sf_dir, t) for t in star.TABLES}


_TEXTS = [(t, c.name) for t, s in star.SPECS.items() for c in s.kept if c.sql_type in ("nvarchar", "nchar")]
_MONEY = [(t, c.name) for t, s in star.SPECS.items() for c in s.kept if c.sql_type == "money"]


def _counts_sql(table: str, column: str, relation: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS nulls, "
        f"count(*) FILTER ({column} = '') AS empties, count(*) FILTER (contains({column}, chr(0))) AS nul_bytes, "
        f"count(*) FILTER ({column} = chr(0)) AS nul_only FROM {relation}"
    )


_DEFECTS = {"dim_customer": planted.SEGMENTS, "dim_part": planted.NUL_NAMES}


def _defective(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: planted.plant(df, _DEFECTS.get(t, {})) for t, df in kept_frames(spark, sf_dir).items()}


@query(
    "column_profile",
    over(
        *star.TABLES,
        also={f"p_{t}": planted.plant_sql(t, d) for t, d in _DEFECTS.items()},
        body=rows_sql([_counts_sql(t, c, f"p_{t}" if t in _DEFECTS else t) for t, c in _TEXTS]),
    ),
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empties and NUL bytes of every text column, with planted segments and names."""
    metrics = ["nulls", "empties", "nul_bytes", "nul_only"]
    parts = []
    for t, df in _defective(spark, sf_dir).items():
        texts = [f.name for f in df.schema.fields if profile.is_text(f.dataType)]
        if texts:
            parts.append(lambda t=t, df=df.select(*texts): profile.column_profile(df, "lake", t))
    long = settle_all(parts).where(f"metric <> '{profile.ROWS}'")
    wide = long.groupBy("table_name", "column_name").pivot("metric", metrics).agg(F.max("value"))
    return wide.select("table_name", "column_name", *[F.col(m).cast("bigint").alias(m) for m in metrics])


@query(
    "token_census",
    over(
        *star.TABLES,
        also={f"p_{t}": planted.plant_sql(t, d) for t, d in _DEFECTS.items()}
        | {
            "texts": rows_sql(
                [
                    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS token FROM {f'p_{t}' if t in _DEFECTS else t}"
                    for t, c in _TEXTS
                ]
            )
        },
        body="SELECT table_name, column_name, token, count(*) AS n FROM texts WHERE token IN ("
        + ", ".join(f"'{t}'" for t in text.WATCHED_TOKENS)
        + ") GROUP BY table_name, column_name, token",
    ),
)
def token_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-like literals in every text column, with planted segments."""
    frames = _defective(spark, sf_dir)
    tables = [t for t in star.TABLES if any(table == t for table, _ in _TEXTS)]
    return settle_all([lambda t=t: profile.token_census(frames[t], "lake", t) for t in tables]).drop("side")


@query(
    "decimal_sums",
    over(
        *star.TABLES,
        body=rows_sql(
            [
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(coalesce(sum({c}), 0) AS DECIMAL(38,4)) AS total FROM {t}"
                for t, c in _MONEY
            ]
        ),
    ),
)
def decimal_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = dict.fromkeys(t for t, _ in _MONEY)
    sums = union_all(profile.decimal_sums(star.frame(spark, sf_dir, t), "lake", t) for t in tables)
    return sums.select("table_name", "column_name", F.col("value").alias("total"))


@query(
    "column_digest",
    over(
        *star.TABLES,
        also={f"h_{t}": f"SELECT {hashable_sql(t)} FROM {t}" for t in star.TABLES},
        body=rows_sql(
            [
                f"SELECT '{t}' AS table_name, '{c.name}' AS column_name, {MD5_SQL.format(c.name)} AS digest FROM h_{t}"
                for t, s in star.SPECS.items()
                for c in s.kept
            ]
        ),
    ),
)
def column_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portable digest of every kept column of every table."""

    def digests(table: str) -> DataFrame:
        df = star.frame(spark, sf_dir, table).selectExpr(*specs.projection(hashable(star.SPECS[table])))
        return profile.column_digests(df, "lake", table, portable=True)

    return settle_all([lambda t=t: digests(t) for t in star.TABLES]).where("metric = 'digest'").select(
        "table_name", "column_name", F.col("value").cast("decimal(38,0)").alias("digest")
    )


@query(
    "dataset_totals",
    over(
        *star.TABLES,
        body=f"SELECT {len(star.TABLES)} AS tables, {sum(len(s.kept) for s in star.SPECS.values())} AS columns, "
        "CAST(sum(rows) AS BIGINT) AS rows FROM ("
        + rows_sql([f"SELECT count(*) AS rows FROM {t}" for t in star.TABLES])
        + ")",
    ),
)
def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = kept_frames(spark, sf_dir)
    per_table = local_frame(spark, [(t, len(df.columns)) for t, df in frames.items()], "table_name string, columns int")
    return (
        profile.row_counts(frames)
        .join(per_table, "table_name")
        .agg(
            F.count(F.lit(1)).cast("int").alias("tables"),
            F.sum("columns").cast("int").alias("columns"),
            F.sum("rows").alias("rows"),
        )
    )


def _split_sql() -> str:
    parts = []
    for t, s in star.SPECS.items():
        for flag in (True, False):
            columns = [c.name for c in s.kept if c.nullable is flag]
            if columns:
                nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
                parts.append(
                    f"SELECT {str(flag).lower()} AS nullable, {len(columns)} AS columns, count(*) * {len(columns)} AS cells, "
                    f"{nulls} AS nulls FROM {t}"
                )
    return (
        "SELECT nullable, CAST(sum(columns) AS BIGINT) AS columns, CAST(sum(cells) AS BIGINT) AS cells, "
        f"CAST(sum(nulls) AS BIGINT) AS nulls FROM ({rows_sql(parts)}) GROUP BY nullable"
    )


@query("nullability_split", over(*star.TABLES, body=_split_sql()))
def nullability_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, cells and NULLs under each pinned flag."""
    catalog = specs.kept_columns(specs.column_catalog(spark, list(star.SPECS.values())))
    measured = settle_all(
        [
            lambda t=t, df=df: profile.long_profile(df, "lake", t, profile.null_metrics(df.schema.fields))
            for t, df in kept_frames(spark, sf_dir).items()
        ]
    )
    per_column = measured.where("metric = 'nulls'").select("table_name", "column_name", F.col("value").alias("nulls"))
    rows = measured.where(f"metric = '{profile.ROWS}'").select("table_name", F.col("value").alias("rows"))
    return (
        catalog.join(per_column, ["table_name", "column_name"])
        .join(rows, "table_name")
        .groupBy("nullable")
        .agg(
            F.count(F.lit(1)).alias("columns"),
            F.sum("rows").cast("bigint").alias("cells"),
            F.sum("nulls").cast("bigint").alias("nulls"),
        )
    )


_DIFFERENT = {"dim_order": planted.WRONG_ORDERS, "dim_customer": planted.SEGMENTS}
_METRICS = ("nulls", "empties", "sum", *[f"token:{t}" for t in text.WATCHED_TOKENS])


def _metric_sql(table: str, relation: str) -> str:
    parts = []
    for c in star.SPECS[table].kept:
        tests = {"nulls": f"count(*) FILTER ({c.name} IS NULL)"}
        if c.sql_type in ("nvarchar", "nchar"):
            tests["empties"] = f"count(*) FILTER ({c.name} = '')"
            tests |= {f"token:{t}": f"count(*) FILTER ({c.name} = '{t}')" for t in text.WATCHED_TOKENS}
        if c.sql_type == "money":
            tests["sum"] = f"sum({c.name})"
        parts += [
            f"SELECT '{table}' AS table_name, '{c.name}' AS column_name, '{m}' AS metric, CAST({e} AS DECIMAL(38,4)) AS value "
            f"FROM {relation}"
            for m, e in tests.items()
        ]
    return rows_sql(parts)


@query(
    "reconcile_profiles",
    over(
        *_DIFFERENT,
        also={f"p_{t}": planted.plant_sql(t, d) for t, d in _DIFFERENT.items()}
        | {
            "l": rows_sql([_metric_sql(t, t) for t in _DIFFERENT]),
            "r": rows_sql([_metric_sql(t, f"p_{t}") for t in _DIFFERENT]),
        },
        body="SELECT table_name, column_name, metric, l.value AS left_value, r.value AS right_value "
        "FROM l FULL JOIN r USING (table_name, column_name, metric) WHERE l.value IS DISTINCT FROM r.value",
    ),
)
def reconcile_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and defective tables profiled in one pass each; the measurements that differ."""

    def side(defects: dict) -> DataFrame:
        return union_all(
            profile.lake_profile(planted.plant(kept_frame(spark, sf_dir, t), defects.get(t, {})), t) for t in _DIFFERENT
        ).where(F.col("metric").isin(*_METRICS))

    return reconcile.differences(side({}), side(_DIFFERENT))


@query(
    "diff_sample",
    over(
        "dim_order",
        also={
            "p": planted.plant_sql("dim_order", planted.WRONG_ORDERS),
            "cells": rows_sql(
                [
                    f"SELECT order_key, '{c.name}' AS column_name, CAST(l.{c.name} AS VARCHAR) AS left_value, "
                    f"CAST(p.{c.name} AS VARCHAR) AS right_value FROM dim_order l JOIN p USING (order_key) "
                    f"WHERE l.{c.name} IS DISTINCT FROM p.{c.name}"
                    for c in star.SPECS["dim_order"].kept
                    if c.name != "order_key"
                ]
            ),
        },
        body="SELECT order_key, column_name, left_value, right_value FROM cells "
        "QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY order_key) <= 2",
    ),
)
def diff_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two differing cells of every column of the orders."""
    orders = star.frame(spark, sf_dir, "dim_order")
    return reconcile.diff_sample(orders, planted.plant(orders, planted.WRONG_ORDERS), ["order_key"])


# A hundred and sixty columns of the line items' numbers, each with gaps of its own.
_NUMBERS = ("extended_price", "quantity", "discount_pct", "order_key")
_WIDE = {
    f"{c}_{i}": f"CASE WHEN line_number <> {i % 7 + 1} THEN CAST({c} AS DECIMAL(19,4)) + {i} END"
    for c in _NUMBERS
    for i in range(40)
}


def wide_lines(lines: DataFrame) -> DataFrame:
    """The columns of ``_WIDE`` over line items.

    A task reads whole row groups, of which a file may have one only, and the
    cells of a row cost far more than reading it: the few columns they are made
    of are dealt over all cores first. Numbers are cast once a row, not once a cell.
    """
    # Without a line number no cell is made, and nothing is cast.
    numbers = {c: f"CASE WHEN line_number IS NOT NULL THEN CAST({c} AS DECIMAL(19,4)) END" for c in _NUMBERS}
    narrow = lines.selectExpr("line_number", *specs.projection(numbers))
    dealt = narrow.repartition(3 * lines.sparkSession.sparkContext.defaultParallelism)
    return dealt.selectExpr(*specs.projection(_WIDE))


@query(
    "wide_profile",
    over(
        "fact_lineitem",
        also={"w": "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _WIDE.items()) + " FROM fact_lineitem"},
        body="SELECT unnest([" + ", ".join(f"'{c}'" for c in _WIDE) + "]) AS column_name, "
        "unnest([" + ", ".join(f"count(*) FILTER ({c} IS NULL)" for c in _WIDE) + "]) AS nulls, "
        "unnest([" + ", ".join(f"CAST(coalesce(sum({c}), 0) AS DECIMAL(38,4))" for c in _WIDE) + "]) AS total FROM w",
    ),
)
def wide_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and sums of a table too wide for one aggregation of all its columns, in one scan."""
    wide = wide_lines(star.frame(spark, sf_dir, "fact_lineitem"))
    fields = wide.schema.fields
    found = profile.long_profile(wide, "lake", "wide", profile.null_metrics(fields) + profile.sum_metrics(fields))
    value = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    return (
        found.where("column_name <> '*'")
        .groupBy("column_name")
        .agg(value("nulls").cast("bigint").alias("nulls"), value("sum").alias("total"))
    )


@query(
    "exclude_columns",
    over(
        *star.TABLES,
        body=rows_sql(
            [
                f"SELECT '{t}' AS table_name, {len(s.kept)} AS kept, {len(s.columns) - len(s.kept)} AS dropped, "
                f"count(*) AS rows FROM {t}"
                for t, s in star.SPECS.items()
            ]
        ),
    ),
)
def exclude_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: columns loaded, columns dropped by their type, and the rows concerned."""
    catalog = specs.column_catalog(spark, list(star.SPECS.values()))
    kept = specs.kept_columns(catalog).groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("kept"))
    listed = catalog.groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("listed"))
    rows = profile.row_counts(star.frames(spark, sf_dir))
    return (
        listed.join(kept, "table_name", "left")
        .join(rows, "table_name")
        .select("table_name", "kept", (F.col("listed") - F.col("kept")).alias("dropped"), "rows")
    )


_WANTED = ["dim_customer", "dim_order", "fact_lineitem", "fact_returns"]


@query(
    "select_tables",
    over(
        *_WANTED[:3],
        body=rows_sql(
            [f"SELECT '{t}' AS table_name, 'selected' AS status, count(*) AS rows FROM {t}" for t in _WANTED[:3]]
            + ["SELECT 'fact_returns', 'missing', 0"]
        ),
    ),
)
def select_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load list with one unknown name; the rows that would be loaded."""
    available = local_frame(spark, [(t,) for t in star.TABLES], "table_name string")
    chosen = specs.select_tables(available, _WANTED)
    rows = profile.row_counts({t: star.frame(spark, sf_dir, t) for t in _WANTED if t in star.TABLES})
    return chosen.join(rows, "table_name", "left").select("table_name", "status", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))


@query(
    "column_catalog",
    over(
        *star.TABLES,
        body=rows_sql(
            [
                f"SELECT '{t}' AS table_name, v.ordinal, v.source_name, v.column_name, v.sql_type, v.nullable, r.rows FROM "
                + values_sql(
                    "ordinal, source_name, column_name, sql_type, nullable",
                    [(i, c.source_name, c.name, c.sql_type, c.nullable) for i, c in enumerate(s.columns)],
                )
                + f", (SELECT count(*) AS rows FROM {t}) r"
                for t, s in star.SPECS.items()
            ]
        ),
    ),
)
def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pinned column in file order, with its table's rows."""
    catalog = specs.column_catalog(spark, list(star.SPECS.values()))
    rows = profile.row_counts(star.frames(spark, sf_dir))
    return catalog.join(rows, "table_name").select(
        "table_name", "ordinal", "source_name", "column_name", "sql_type", "nullable", "rows"
    )
