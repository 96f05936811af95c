"""Queries: relationships from names, from declarations, and their evidence in the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.functions import typing
from lakeproof.operators import edges as rel
from lakeproof.operators import keys, profile
from lakeproof.operators.keys import Edge, spell_edge
from lakeproof.plans import checks, star
from lakeproof.plans.queries_keys import ALL_EDGES, _tables, edge_sql
from lakeproof.plans.registry import over, query, rows_sql, values_sql
from lakeproof.session import local_frame
from lakeproof.sources import constraints, specs


def catalog(spark: SparkSession) -> DataFrame:
    return specs.kept_columns(specs.column_catalog(spark, list(star.SPECS.values())))


def evidence(spark: SparkSession, sf_dir: str, edges: tuple[Edge, ...]) -> DataFrame:
    """What the data says about each edge: values compared, orphans, repeated targets."""
    return keys.edge_audit(star.frames(spark, sf_dir, _tables(edges)), edges)


def _spelled(edges: DataFrame) -> DataFrame:
    return edges.withColumn("edge", rel.spelled())


# Every *_key column, placed by hand.
_KINDS = [
    ("dim_region", "region_key", "own key", None, None),
    ("dim_nation", "nation_key", "own key", None, None),
    ("dim_nation", "region_key", "dimension", "dim_region", "region_key"),
    ("dim_customer", "customer_key", "own key", None, None),
    ("dim_customer", "parent_customer_key", "hierarchy", "dim_customer", "customer_key"),
    ("dim_customer", "customer_alternate_key", "natural key", None, None),
    ("dim_customer", "nation_key", "dimension", "dim_nation", "nation_key"),
    ("dim_supplier", "supplier_key", "own key", None, None),
    ("dim_supplier", "supplier_alternate_key", "natural key", None, None),
    ("dim_supplier", "nation_key", "dimension", "dim_nation", "nation_key"),
    ("dim_part", "part_key", "own key", None, None),
    ("dim_date", "date_key", "own key", None, None),
    ("dim_date", "full_date_alternate_key", "natural key", None, None),
    ("dim_order", "order_key", "own key", None, None),
    ("dim_order", "customer_key", "dimension", "dim_customer", "customer_key"),
    ("dim_order", "order_date_key", "date role", "dim_date", "date_key"),
    ("fact_lineitem", "order_key", "dimension", "dim_order", "order_key"),
    ("fact_lineitem", "part_key", "dimension", "dim_part", "part_key"),
    ("fact_lineitem", "supplier_key", "dimension", "dim_supplier", "supplier_key"),
    ("fact_lineitem", "ship_date_key", "date role", "dim_date", "date_key"),
    ("dim_document", "document_key", "own key", None, None),
    ("fact_document_label", "document_key", "dimension", "dim_document", "document_key"),
    # Planted: a fact with a key of its own, and one that nobody can place.
    ("fact_event", "event_key", "own key", None, None),
    ("fact_event", "batch_key", "unclassified", None, None),
]
_EVENT_KEYS = {"event_key": "event_id", "batch_key": "user_id"}


@query(
    "derive_edges",
    over(
        *star.TABLES,
        also={
            "counted": rows_sql(
                [
                    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                    f"count({_EVENT_KEYS.get(c, c)}) AS filled FROM {t}"
                    for t, c, *_ in _KINDS
                ]
            )
        },
        body="SELECT table_name, column_name, kind, to_table, to_column, filled FROM "
        + values_sql("table_name, column_name, kind, to_table, to_column", _KINDS)
        + " JOIN counted USING (table_name, column_name)",
    ),
)
def derive_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key column's kind and target, with the values it holds."""
    frames = star.frames(spark, sf_dir)
    frames["fact_event"] = frames["fact_event"].selectExpr("*", *[f"{v} AS {c}" for c, v in _EVENT_KEYS.items()])
    extra = local_frame(spark, [("fact_event", c) for c in _EVENT_KEYS], "table_name string, column_name string")
    columns = catalog(spark).select("table_name", "column_name").unionAll(extra)
    classified = rel.classify_keys(columns)
    measured = profile.union_all(
        profile.long_profile(
            df, "lake", t, [profile.Metric(c, "filled", "count", f"{c} IS NOT NULL") for c in df.columns if c.endswith(rel.KEY)]
        )
        for t, df in frames.items()
        if any(c.endswith(rel.KEY) for c in df.columns)
    ).where("metric = 'filled'")
    filled = measured.select("table_name", "column_name", F.col("value").cast("bigint").alias("filled"))
    return classified.join(filled, ["table_name", "column_name"])


_OWN = [(t, c) for t, c, kind, *_ in _KINDS if kind == "own key" and c not in _EVENT_KEYS]


@query(
    "derive_primary_keys",
    over(
        *[t for t, _ in _OWN],
        body=rows_sql(
            [
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) - count(DISTINCT {c}) AS surplus FROM {t}"
                for t, c in _OWN
            ]
        ),
    ),
)
def derive_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables' own keys by name, and whether the data agrees."""
    derived = rel.primary_keys(catalog(spark))
    of = [(r.table_name, (r.column_name,)) for r in derived.collect()]
    tested = keys.key_audit(star.frames(spark, sf_dir, [t for t, _ in of]), of)
    return derived.join(tested.withColumnRenamed("key_name", "column_name"), ["table_name", "column_name"]).select(
        "table_name", "column_name", "rows", "surplus"
    )


def derived_sets(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Declared, derived, hierarchy and curated edges."""
    classified = rel.classify_keys(catalog(spark))
    return (
        rel.edge_frame(spark, star.DECLARED),
        rel.derived_edges(classified),
        rel.hierarchy_edges(classified),
        rel.edge_frame(spark, star.CURATED),
    )


@query(
    "edge_union",
    over(
        *_tables(ALL_EDGES),
        body=f"SELECT edge, compared FROM ({rows_sql([edge_sql(e) for e in ALL_EDGES])})",
    ),
)
def edge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared, derived and curated edges, each once, with the values it compares."""
    declared, derived, _, curated = derived_sets(spark)
    edges = rel.edge_list(rel.edge_union(declared, derived, curated))
    return evidence(spark, sf_dir, tuple(edges)).select("edge", "compared")


_VERDICTS = (
    [(spell_edge(e), "missed" if len(e[1]) > 1 else "routed" if e[0] == e[2] else "agreed") for e in star.DECLARED]
    + [(spell_edge(e), "invented") for e in star.UNDECLARED]
)


@query(
    "edge_diff",
    over(
        *_tables(ALL_EDGES),
        also={"audit": rows_sql([edge_sql(e) for e in star.DECLARED + star.UNDECLARED])},
        body="SELECT edge, verdict, compared, orphan_rows FROM "
        + values_sql("edge, verdict", _VERDICTS)
        + " JOIN audit USING (edge)",
    ),
)
def edge_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names against declarations, with the evidence for each edge."""
    declared, derived, hierarchies, _ = derived_sets(spark)
    verdicts = _spelled(rel.edge_diff(declared, derived, hierarchies)).select("edge", "verdict")
    audit = evidence(spark, sf_dir, star.DECLARED + star.UNDECLARED)
    return verdicts.join(audit, "edge").select("edge", "verdict", "compared", "orphan_rows")


# A curated list gone wrong: twice the same entry, one that is declared, one that
# is the declared composite spelled in another column order.
_SWAPPED: Edge = (
    "fact_conversation",
    ("prior_turn_number", "conversation_id"),
    "fact_conversation",
    ("turn_number", "conversation_id"),
)
_LISTED: tuple[Edge, ...] = (*star.CURATED, *star.CURATED, star.DECLARED[4], _SWAPPED)
_REASONS = [
    (spell_edge(star.CURATED[0]), "duplicate"),
    (spell_edge(star.DECLARED[4]), "covered"),
    (spell_edge(star.DECLARED[10]), "covered"),
]


@query(
    "edge_minimality",
    over(
        *_tables(ALL_EDGES),
        also={"audit": rows_sql([edge_sql(e) for e in (star.CURATED[0], star.DECLARED[4], star.DECLARED[10])])},
        body="SELECT edge, reason, compared FROM " + values_sql("edge, reason", _REASONS) + " JOIN audit USING (edge)",
    ),
)
def edge_minimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated edges that are not needed, and how many values they would test again."""
    declared, derived, hierarchies, _ = derived_sets(spark)
    redundant = rel.not_minimal(rel.edge_frame(spark, _LISTED), declared, derived, hierarchies)
    audit = evidence(spark, sf_dir, star.CURATED + star.DECLARED).select("edge", "compared")
    return _spelled(redundant).select("edge", "reason").join(audit, "edge")


_BROKEN: tuple[Edge, ...] = (
    ("fact_lineitem", ("promotion_key",), "dim_promotion", ("promotion_key",)),
    ("dim_order", ("customer_key",), "dim_customer", ("customer_code",)),
    ("fact_lineitem", ("order_key", "line_number"), "dim_order", ("order_key", "line_no")),
)
_ABSENT = [
    (spell_edge(_BROKEN[0]), "fact_lineitem", "dim_promotion", None),
    (spell_edge(_BROKEN[0]), "fact_lineitem", "fact_lineitem", "promotion_key"),
    (spell_edge(_BROKEN[1]), "dim_order", "dim_customer", "customer_code"),
    (spell_edge(_BROKEN[2]), "fact_lineitem", "dim_order", "line_no"),
]


@query(
    "edge_structure",
    over(
        "fact_lineitem",
        "dim_order",
        body="SELECT edge, v.table_name, column_name, rows AS unchecked_rows FROM "
        + values_sql("edge, child, table_name, column_name", _ABSENT)
        + " JOIN (SELECT 'fact_lineitem' AS child, count(*) AS rows FROM fact_lineitem UNION ALL "
        "SELECT 'dim_order', count(*) FROM dim_order) USING (child)",
    ),
)
def edge_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What declared edges lack, and the child rows nobody can check because of it."""
    declared = rel.edge_frame(spark, star.DECLARED + _BROKEN)
    broken = rel.broken_structure(declared, catalog(spark))
    children = _spelled(declared).select("edge", F.col("from_table").alias("child"))
    rows = profile.row_counts(star.frames(spark, sf_dir, dict.fromkeys(e[0] for e in _BROKEN)))
    counted = children.join(rows.select(F.col("table_name").alias("child"), "rows"), "child")
    return broken.join(counted, "edge").select("edge", "table_name", "column_name", F.col("rows").alias("unchecked_rows"))


@query(
    "constraint_totals",
    over(
        *_tables(star.DECLARED),
        body="SELECT count(*) AS constraints, count(*) FILTER (edge LIKE '%+%') AS composites, "
        f"CAST(sum(compared) AS BIGINT) AS compared FROM ({rows_sql([edge_sql(e) for e in star.DECLARED])})",
    ),
)
def constraint_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared constraints, composite ones among them, and the values they cover."""
    totals = rel.edge_totals(rel.edge_frame(spark, star.DECLARED))
    covered = evidence(spark, sf_dir, star.DECLARED).agg(F.sum("compared").alias("compared"))
    both = totals.unionByName(covered, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("constraints", "composites", "compared")])


def system_relations(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """The declared constraints as a source's system tables would hold them.

    Names are the source's, columns of a constraint come in no useful order, and
    one constraint belongs to a table that is never loaded.
    """
    columns_of = {t: list(s.columns) for t, s in star.SPECS.items()}
    table_ids = {t: 100 + i for i, t in enumerate(star.SPECS)}
    source = {t: s.source_table.split(".")[1] for t, s in star.SPECS.items()}
    tables = [(table_ids[t], 1, source[t]) for t in star.SPECS] + [(99, 1, typing.EXCLUDED_TABLES[0])]
    columns = [(table_ids[t], i, c.source_name) for t, cs in columns_of.items() for i, c in enumerate(cs)]
    columns.append((99, 0, "DatabaseLogId"))

    def column_id(table: str, column: str) -> int:
        return next(i for i, c in enumerate(columns_of[table]) if c.name == column)

    named, members = [], []
    for i, (child, fk, parent, pk) in enumerate(star.DECLARED):
        named.append((i, f"FK_{source[child]}_{'_'.join(fk)}", table_ids[child], table_ids[parent]))
        for ordinal in range(len(fk), 0, -1):
            members.append((i, ordinal, column_id(child, fk[ordinal - 1]), column_id(parent, pk[ordinal - 1])))
    named.append((len(named), "FK_Log", 99, 99))
    members.append((len(named) - 1, 1, 0, 0))
    return (
        local_frame(spark, named, "constraint_id int, constraint_name string, child_id int, parent_id int"),
        local_frame(spark, members, "constraint_id int, ordinal int, child_column_id int, parent_column_id int"),
        local_frame(spark, tables, "table_id int, schema_id int, table_name string"),
        local_frame(spark, [(1, "dbo")], "schema_id int, schema_name string"),
        local_frame(spark, columns, "table_id int, column_id int, column_name string"),
    )


@query(
    "assemble_constraints",
    over(
        *_tables(star.DECLARED),
        also={"audit": rows_sql([edge_sql(e) for e in star.DECLARED])},
        body="SELECT constraint_name, from_table, from_columns, to_table, to_columns, compared FROM "
        + values_sql(
            "edge, constraint_name, from_table, from_columns, to_table, to_columns",
            [
                (
                    spell_edge(e),
                    f"FK_{star.SPECS[e[0]].source_table[4:]}_{'_'.join(e[1])}",
                    e[0],
                    ",".join(e[1]),
                    e[2],
                    ",".join(e[3]),
                )
                for e in star.DECLARED
            ],
        )
        + " JOIN audit USING (edge)",
    ),
)
def assemble_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints put together from system tables, then tested on the data."""
    named, members, tables, schemas, columns = system_relations(spark)
    assembled = constraints.assemble_constraints(named, members, tables, schemas, columns)
    loss = constraints.column_loss(assembled, named, members, tables).first()
    if loss.declared != loss.kept:
        raise RuntimeError(f"{loss.declared} constraint columns are declared, {loss.kept} were assembled")
    audit = evidence(spark, sf_dir, tuple(rel.edge_list(assembled))).select("edge", "compared")
    return _spelled(assembled).join(audit, "edge").select(
        "constraint_name",
        "from_table",
        F.concat_ws(",", "from_columns").alias("from_columns"),
        "to_table",
        F.concat_ws(",", "to_columns").alias("to_columns"),
        "compared",
    )


_USED = sorted({c.sql_type for s in star.SPECS.values() for c in s.kept})
_PINNED = sorted({g[0] for g in typing.GOLDEN_TYPES})


def _coverage_sql() -> str:
    parts = []
    for t, s in star.SPECS.items():
        for kind in dict.fromkeys(c.sql_type for c in s.kept):
            n = sum(c.sql_type == kind for c in s.kept)
            parts.append(f"SELECT '{kind}' AS sql_type, {n} AS columns, count(*) * {n} AS cells FROM {t}")
    parts += [f"SELECT '{kind}', 0, 0" for kind in _PINNED if kind not in _USED]
    return (
        "SELECT sql_type, CAST(sum(columns) AS BIGINT) AS columns, CAST(sum(cells) AS BIGINT) AS cells, "
        "CASE WHEN sum(columns) = 0 THEN 'unexercised' ELSE 'covered' END AS finding "
        f"FROM ({rows_sql(parts)}) GROUP BY sql_type"
    )


@query("type_coverage", over(*star.TABLES, body=_coverage_sql()))
def type_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pinned type with the columns and cells that exercise it."""
    columns = catalog(spark)
    findings = rel.type_coverage(checks.golden_frame(spark), columns)
    rows = profile.row_counts(star.frames(spark, sf_dir))
    used = (
        columns.join(rows, "table_name")
        .groupBy("sql_type")
        .agg(F.count(F.lit(1)).alias("columns"), F.sum("rows").alias("cells"))
    )
    return used.join(findings, "sql_type", "full_outer").select(
        "sql_type",
        F.coalesce("columns", F.lit(0)).cast("bigint").alias("columns"),
        F.coalesce("cells", F.lit(0)).cast("bigint").alias("cells"),
        F.coalesce("finding", F.lit("covered")).alias("finding"),
    )
