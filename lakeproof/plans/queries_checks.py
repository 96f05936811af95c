"""Queries: each check on clean data and on data with a planted defect."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.functions import text, typing
from lakeproof.functions.casting import strict_cast
from lakeproof.operators import assertions, keys, profile
from lakeproof.operators import edges as rel
from lakeproof.operators.keys import Edge
from lakeproof.operators.profile import union_all
from lakeproof.plans import checks, planted, staging, star, verify
from lakeproof.plans.queries_edges import _BROKEN, _LISTED, _VERDICTS, catalog, evidence
from lakeproof.plans.queries_ingest import fresh_database, planted_extract
from lakeproof.plans.queries_keys import ALL_EDGES, _tables, edge_sql, stray_frames
from lakeproof.plans.queries_profile import kept_frames
from lakeproof.plans.registry import over, query, rows_sql, values_sql
from lakeproof.session import materialise, new_scratch, settle_all
from lakeproof.sources import delimited, footers, lake, specs


def verdicts(check: str, clean: DataFrame, planted_: DataFrame) -> DataFrame:
    """(side, check_name, status, checked, failed) of the check on both sides."""
    columns = ["check_name", "status", "checked", "failed"]
    return union_all(
        assertions.summarise(found, [check]).select(F.lit(side).alias("side"), *columns)
        for side, found in (("clean", clean), ("planted", planted_))
    )


def verdict_sql(check: str, checked: str, failed: dict[str, str]) -> str:
    """The same from two numbers per side, each a scalar subquery or literal."""
    return rows_sql(
        [
            f"SELECT '{side}' AS side, '{check}' AS check_name, CASE WHEN failed > 0 THEN 'FAIL' ELSE 'PASS' END AS status, "
            f"CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed FROM (SELECT {checked} AS checked, {n} AS failed)"
            for side, n in failed.items()
        ]
    )


def _stored(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A stored table as it lies there, without the guard."""
    return spark.read.schema(star.SPECS[table].stored_schema).parquet(staging.stored(spark, sf_dir, table))


_ALL = tuple(star.SPECS)
_COLUMNS = sum(len(s.kept) for s in star.SPECS.values())
_REQUIRED = sum(not c.nullable for s in star.SPECS.values() for c in s.kept)
_LOST = "account_balance < 0"


def _known(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """The totals of the tables as they were given."""
    rows = profile.row_counts(kept_frames(spark, sf_dir)).agg(F.sum("rows")).first()[0]
    return {
        "rows": rows,
        "tables": len(_ALL),
        "columns": _COLUMNS,
        "constraints": len(star.DECLARED),
        "composites": sum(len(e[1]) > 1 for e in star.DECLARED),
    }


@query(
    "check_baseline",
    over(
        "dim_customer",
        body=verdict_sql(
            "known_baseline",
            "3",
            {"clean": "0", "planted": f"(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim_customer WHERE {_LOST})"},
        ),
    ),
)
def check_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored tables against known totals; then with customers lost."""
    staging.stored_all(spark, sf_dir)
    known = _known(spark, sf_dir)

    def side(lossy: bool) -> DataFrame:
        parts = []
        for t in _ALL:
            df = _stored(spark, sf_dir, t)
            if lossy and t == "dim_customer":
                df = df.where(f"NOT ({_LOST})")
            parts.append(lambda t=t, df=df: profile.long_profile(df, "lake", t, profile.null_metrics(df.schema.fields)))
        return checks.known_baseline(settle_all(parts), known)

    return verdicts("known_baseline", side(False), side(True))


@query(
    "check_row_counts",
    over(
        "dim_customer",
        body=verdict_sql(
            "row_counts",
            str(len(_ALL)),
            {"clean": "0", "planted": f"(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim_customer WHERE {_LOST})"},
        ),
    ),
)
def check_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows parsed from every extract against rows stored."""
    staging.stored_all(spark, sf_dir)
    source = settle_all(
        [lambda t=t: profile.long_profile(staging.raw(spark, sf_dir, t), "source", t, []) for t in _ALL]
    )

    def side(lossy: bool) -> DataFrame:
        frames = {t: _stored(spark, sf_dir, t) for t in _ALL}
        if lossy:
            frames["dim_customer"] = frames["dim_customer"].where(f"NOT ({_LOST})")
        return checks.row_counts(source, union_all(profile.long_profile(df, "lake", t, []) for t, df in frames.items()))

    return verdicts("row_counts", side(False), side(True))


def _footers(spark: SparkSession, sf_dir: str, replaced: dict[str, str]) -> DataFrame:
    """Stored types and flags of all tables, some of them read elsewhere."""
    paths = staging.stored_all(spark, sf_dir) | replaced
    return footers.stored_catalog(spark, paths)


def _second_file(spark: SparkSession, sf_dir: str, table: str, change) -> str:
    """The stored table in a folder of its own, to which files of changed rows are added, one for each task that reads."""
    path = new_scratch(spark, f"two-{table}")
    staging.scan(spark, sf_dir, table).write.parquet(path)
    change(_stored(spark, sf_dir, table)).write.mode("append").parquet(path)
    return path


@query("check_types", verdict_sql("types", str(_COLUMNS), {"clean": "0", "planted": "2"}))
def check_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types as stored in every file; then with a price as double and a line number as bigint in further files."""
    wrong = {
        t: _second_file(spark, sf_dir, t, lambda df, c=c, of=of: df.withColumn(c, F.col(c).cast(of)))
        for t, c, of in (("dim_order", "total_price", "double"), ("fact_lineitem", "line_number", "bigint"))
    }
    columns = catalog(spark)
    return verdicts(
        "types", checks.types(columns, _footers(spark, sf_dir, {})), checks.types(columns, _footers(spark, sf_dir, wrong))
    )


# Per pinned type, a column of the test tables whose text the type must accept.
_TEXT_OF = {
    "bit": ("fact_document_label", "CAST(CAST(toxic_flag AS INT) AS STRING)"),
    "tinyint": ("fact_lineitem", "CAST(line_number AS STRING)"),
    "smallint": ("dim_part", "CAST(part_size AS STRING)"),
    "int": ("dim_order", "CAST(order_date_key AS STRING)"),
    "bigint": ("fact_event", "CAST(event_id AS STRING)"),
    "real": ("fact_lineitem", "CAST(discount_pct AS STRING)"),
    "float": ("fact_event", "CAST(event_value AS STRING)"),
    "decimal": ("dim_order", "CAST(order_key AS STRING)"),
    "numeric": ("dim_order", "CAST(CAST(total_price AS DECIMAL(9,2)) AS STRING)"),
    "money": ("fact_lineitem", "CAST(extended_price AS STRING)"),
    "smallmoney": ("dim_supplier", "CAST(account_balance AS STRING)"),
    "date": ("dim_date", "CAST(full_date_alternate_key AS STRING)"),
    "datetime": ("dim_order", "CAST(order_date AS STRING)"),
    "datetime2": ("fact_event", "CAST(event_time AS STRING)"),
    "smalldatetime": ("fact_lineitem", "CAST(ship_date AS STRING)"),
    "datetimeoffset": ("fact_event", "concat(CAST(event_time AS STRING), '+00:00')"),
    "nvarchar": ("dim_document", "document_text"),
    "nchar": ("dim_order", "order_status"),
    "varchar": ("fact_page", "page_url"),
    "char": ("fact_lineitem", "return_flag"),
    "xml": ("fact_page", "page_html"),
}


@query(
    "check_type_mapping",
    over(
        *dict.fromkeys(t for t, _ in _TEXT_OF.values()),
        body=rows_sql(
            [
                f"SELECT '{kind}' AS sql_type, '{stored}' AS stored_type, true AS ok, "
                f"{f'(SELECT count(*) FROM {_TEXT_OF[kind][0]})' if kind in _TEXT_OF else '0'} AS parsed"
                for kind, _, _, stored in typing.GOLDEN_TYPES
            ]
        ),
    ),
)
def check_type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The golden cases, and how many values of a fitting column each type takes.

    TIME columns need a session setting, so that case is only compared.
    """
    counted = []
    for kind, precision, scale, stored in typing.GOLDEN_TYPES:
        if kind not in _TEXT_OF:
            continue
        table, value = _TEXT_OF[kind]
        # Loud: one value the type does not take fails the query.
        typed = strict_cast("value", typing.spark_type(kind, precision, scale), kind)
        column = star.frame(spark, sf_dir, table).selectExpr(f"{value} AS value").selectExpr(f"{typed} AS value")
        counted.append(column.selectExpr(f"'{kind}' AS sql_type", f"'{stored}' AS stored_type", "xxhash64(value) IS NOT NULL AND value IS NOT NULL AS taken"))
    parsed = union_all(
        c.groupBy("sql_type", "stored_type").agg(F.count_if("taken").alias("parsed")) for c in counted
    )
    mapped = checks.golden_frame(spark).select(
        "sql_type",
        "stored_type",
        (typing.expected_type(F.col("sql_type"), F.col("precision"), F.col("scale")) == F.col("stored_type")).alias("ok"),
    )
    return mapped.join(parsed, ["sql_type", "stored_type"], "left").select(
        "sql_type", "stored_type", "ok", F.coalesce("parsed", F.lit(0)).cast("bigint").alias("parsed")
    )


@query(
    "check_nullability",
    over(
        "dim_order",
        body=verdict_sql(
            "nullability_flags",
            str(_COLUMNS + _REQUIRED),
            # Every flag of the rewritten table is lost, and one column holds NULLs.
            {
                "clean": "0",
                "planted": f"{sum(not c.nullable for c in star.SPECS['dim_order'].kept)} + "
                "(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim_order WHERE order_priority = '5-LOW')",
            },
        ),
    ),
)
def check_nullability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags in every file and NULLs in the columns; then one more file from an unguarded load with NULLs."""
    path = _second_file(spark, sf_dir, "dim_order", lambda df: planted.plant(df, planted.STRAY_CUSTOMERS))

    def side(replaced: dict[str, str]) -> DataFrame:
        parts = []
        for t in _ALL:
            schema = star.SPECS[t].stored_schema
            df = spark.read.schema(schema).parquet(replaced.get(t) or staging.stored(spark, sf_dir, t))
            parts.append(lambda t=t, df=df: profile.long_profile(df, "lake", t, profile.null_metrics(df.schema.fields)))
        return checks.nullability_flags(catalog(spark), _footers(spark, sf_dir, replaced), settle_all(parts))

    return verdicts("nullability_flags", side({}), side({"dim_order": path}))


_GUARDED = sum(any(not c.nullable for c in s.kept) for s in star.SPECS.values()) + 2 * _REQUIRED


@query("check_not_null_enforced", verdict_sql("nullability_enforced", str(_GUARDED), {"clean": "0", "planted": str(2 * _REQUIRED)}))
def check_not_null_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard on every NOT NULL column of every table; then the same with the guard taken away."""
    stored = staging.stored_all(spark, sf_dir)
    frames = {t: spark.read.schema(star.SPECS[t].stored_schema).parquet(stored[t]) for t in _ALL}
    clean = checks.guard_enforced(spark, frames, star.SPECS)
    return verdicts("nullability_enforced", clean, checks.guard_enforced(spark, frames, star.SPECS, lambda spec, column, value: value))


def _relaxed(table: str) -> specs.TableSpec:
    """The spec without its NOT NULL flags, for tables with planted gaps."""
    spec = star.SPECS[table]
    columns = tuple(specs.PinnedColumn(c.source_name, c.name, c.sql_type, True, c.precision, c.scale) for c in spec.columns)
    return specs.TableSpec(spec.source_table, spec.table, columns, spec.multi_line)


def _sides(
    spark: SparkSession, sf_dir: str, in_source: dict[str, dict[str, str]], in_lake: dict[str, dict[str, str]]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Profiles of extracts, of what was loaded from them, and of a faulty load.

    ``in_source`` plants values in the extract; ``in_lake`` plants a loader's
    fault into the stored tables. One table is extracted, loaded and profiled
    whole, whatever is planted.
    """
    source, clean, faulty = [], [], []
    for t, defect in in_source.items():
        spec = _relaxed(t)
        path = planted_extract(spark, sf_dir, t, defect) if defect else staging.extract(spark, sf_dir, t)
        raw = delimited.fields(spark, path, spec)
        source.append(lambda raw=raw, spec=spec: profile.source_profile(raw, spec, "source"))
        loaded = materialise(delimited.pin(raw, spec), f"loaded-{t}")
        bad = planted.plant(loaded, in_lake.get(t, {}))
        clean.append(lambda t=t, df=loaded: profile.lake_profile(df, t, "clean"))
        faulty.append(lambda t=t, df=bad: profile.lake_profile(df, t, "faulty"))
    sides = settle_all(source + clean + faulty)
    return tuple(sides.where(F.col("side") == side) for side in ("source", "clean", "faulty"))


def _texts(*tables: str) -> int:
    return sum(c.sql_type in ("nvarchar", "nchar") for t in tables for c in star.SPECS[t].kept)


_LOADER_NULLS = {"market_segment": "CASE WHEN market_segment = 'NA' THEN NULL ELSE market_segment END"}


@query(
    "check_null_reconciliation",
    over(
        "dim_customer",
        also={"p": planted.plant_sql("dim_customer", planted.SEGMENTS)},
        body=verdict_sql(
            "null_reconciliation",
            str(_texts("dim_customer")),
            {"clean": "0", "planted": "(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM p WHERE market_segment = 'NA')"},
        ),
    ),
)
def check_null_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty fields against NULLs; then with 'NA' turned into NULL by the loader."""
    source, clean, faulty = _sides(
        spark, sf_dir, {"dim_customer": planted.SEGMENTS}, {"dim_customer": _LOADER_NULLS}
    )
    columns = catalog(spark).where("table_name = 'dim_customer'")
    return verdicts(
        "null_reconciliation",
        checks.null_reconciliation(source, clean, columns),
        checks.null_reconciliation(source, faulty, columns),
    )


@query(
    "check_source_values",
    over(
        "dim_customer",
        "dim_part",
        also={
            "p": planted.plant_sql("dim_customer", planted.SEGMENTS),
            "n": planted.plant_sql("dim_part", planted.NUL_NAMES),
            "seen": "SELECT (SELECT count(DISTINCT market_segment) FROM p WHERE market_segment IN ('NA', 'null')) + "
            "(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM n WHERE part_name = chr(0)) AS clean",
        },
        body=rows_sql(
            [
                "SELECT 'clean' AS side, 'source_values' AS check_name, 'PASS' AS status, CAST(clean + 1 AS BIGINT) AS checked, "
                "CAST(0 AS BIGINT) AS failed FROM seen",
                # The lost token, and the NUL bytes that are still there.
                "SELECT 'planted', 'source_values', 'FAIL', CAST(clean + 1 AS BIGINT), CAST(2 AS BIGINT) FROM seen",
            ]
        ),
    ),
)
def check_source_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and NUL fields; then 'NA' lost and NUL bytes left in other names."""
    nul_kept = {"part_name": "CASE WHEN part_name LIKE '%x' THEN concat(part_name, chr(0)) ELSE part_name END"}
    source, clean, faulty = _sides(
        spark,
        sf_dir,
        {"dim_customer": planted.SEGMENTS, "dim_part": planted.NUL_NAMES},
        {"dim_customer": _LOADER_NULLS, "dim_part": nul_kept},
    )
    return verdicts("source_values", checks.source_values(source, clean), checks.source_values(source, faulty))


_ORDER_COLUMNS = len(star.SPECS["dim_order"].kept)


@query("check_value_digests", verdict_sql("value_digests", str(_ORDER_COLUMNS), {"clean": "0", "planted": "3"}))
def check_value_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the orders; then a cent added, dates shifted, a column replaced."""
    source, clean, faulty = _sides(spark, sf_dir, {"dim_order": {}}, {"dim_order": planted.WRONG_ORDERS})
    return verdicts("value_digests", checks.value_digests(source, clean), checks.value_digests(source, faulty))


@query(
    "check_decimals",
    over(
        "dim_order",
        body=verdict_sql(
            "decimal_exactness",
            "1",
            {"clean": "0", "planted": "(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim_order WHERE order_status = 'P')"},
        ),
    ),
)
def check_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' money text against the stored sums; then a cent off."""
    source, clean, faulty = _sides(spark, sf_dir, {"dim_order": {}}, {"dim_order": planted.WRONG_ORDERS})
    return verdicts(
        "decimal_exactness", checks.decimal_exactness(source, clean), checks.decimal_exactness(source, faulty)
    )


_WRONG = tuple(planted.WRONG_ORDERS)


@query(
    "value_findings",
    over(
        "dim_order",
        also={
            "p": planted.plant_sql("dim_order", planted.WRONG_ORDERS),
            "cells": rows_sql(
                [f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v, {n} AS n FROM {t}" for c in _WRONG for t, n in (("dim_order", 1), ("p", -1))]
            ),
            "surplus": "SELECT c, v, sum(n) AS n FROM cells GROUP BY c, v HAVING sum(n) <> 0",
            "ranked": "SELECT c, v, n > 0 AS extracted, row_number() OVER (PARTITION BY c, n > 0 ORDER BY v) AS i FROM surplus",
            "shown": "SELECT c, string_agg(v, ', ' ORDER BY v) FILTER (extracted) AS l, "
            "string_agg(v, ', ' ORDER BY v) FILTER (NOT extracted) AS r FROM ranked WHERE i <= 2 GROUP BY c",
        },
        body="SELECT 'dim_order.' || c AS subject, coalesce('only in the extract: ' || l, '') || "
        "CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN '; ' ELSE '' END || coalesce('only in the lake: ' || r, '') AS shown FROM shown",
    ),
)
def value_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the digest check shows of the orders whose prices, dates and priorities are wrong."""
    spec = _relaxed("dim_order")
    raw = delimited.fields(spark, staging.extract(spark, sf_dir, "dim_order"), spec)
    loaded = materialise(delimited.pin(raw, spec), "loaded-dim_order")
    bad = planted.plant(loaded, planted.WRONG_ORDERS)
    sides = settle_all([lambda: profile.source_profile(raw, spec, "source"), lambda: profile.lake_profile(bad, "dim_order", "lake")])
    found = checks.value_digests(sides.where("side = 'source'"), sides.where("side = 'lake'"), lambda _: (loaded, bad))
    return found.where("NOT ok").selectExpr("subject", "substring(actual, instr(actual, ';') + 2) AS shown")


_OWN_KEYS = [(t, k) for t, k in star.CANDIDATE_KEYS.items() if t.startswith("dim_")]


@query(
    "check_primary_keys",
    over(
        "dim_customer",
        body=verdict_sql(
            "primary_keys",
            str(len(_OWN_KEYS)),
            {"clean": "0", "planted": f"(SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim_customer WHERE {_LOST})"},
        ),
    ),
)
def check_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight own keys; then with some customers loaded twice."""
    frames = star.frames(spark, sf_dir, [t for t, _ in _OWN_KEYS])
    customers = frames["dim_customer"]
    twice = frames | {"dim_customer": customers.unionAll(customers.where(_LOST))}
    return verdicts("primary_keys", checks.primary_keys(frames, _OWN_KEYS), checks.primary_keys(twice, _OWN_KEYS))


@query(
    "key_findings",
    over(
        "dim_customer", "dim_order",
        also={
            "stray": planted.plant_sql("dim_order", planted.STRAY_CUSTOMERS),
            "twice": "SELECT customer_key AS k FROM dim_customer WHERE nation_key < 5",
            "orphan": "SELECT customer_key AS k FROM stray WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer) GROUP BY customer_key",
        },
        body="SELECT 'primary_keys' AS check_name, 'dim_customer.customer_key' AS subject, '0 surplus, 0 NULL' AS expected, "
        "(SELECT count(*) FROM twice) || ' surplus, 0 NULL, such as ' || (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM twice ORDER BY k LIMIT 3)) AS actual "
        "UNION ALL SELECT 'referential_integrity', 'dim_order.customer_key -> dim_customer.customer_key', '0 orphans, 0 surplus', "
        "(SELECT count(*) FROM orphan) || ' orphans, 0 surplus, such as ' || (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM orphan ORDER BY k LIMIT 3))",
    ),
)
def key_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks say of customers loaded twice and of orders without a customer, with the first three keys."""
    frames = star.frames(spark, sf_dir, ["dim_customer", "dim_order"])
    customers = frames["dim_customer"]
    twice = frames | {"dim_customer": customers.unionAll(customers.where("nation_key < 5"))}
    own = checks.primary_keys(twice, [("dim_customer", ("customer_key",)), ("dim_order", ("order_key",))])
    stray = frames | {"dim_order": planted.plant(frames["dim_order"], planted.STRAY_CUSTOMERS)}
    edges = [("dim_order", ("customer_key",), "dim_customer", ("customer_key",))]
    audit = keys.edge_audit(stray, edges)
    found = own.unionAll(checks.referential_integrity(audit, rel.classify_keys(catalog(spark)), stray, edges))
    return assertions.findings(found).select("check_name", "subject", "expected", "actual")


_REVERSED: Edge = ("dim_customer", ("customer_key",), "dim_order", ("customer_key",))


@query(
    "check_edge_oracle",
    over(
        *_tables(star.DECLARED),
        "fact_event",
        also={"audit": rows_sql([edge_sql(e) for e in star.DECLARED + star.CURATED])},
        body="SELECT s.side, 'foreign_key_oracle' AS check_name, s.status, s.checked, s.failed, c.compared FROM "
        # Clean: one curated edge, two totals, eleven declared edges. Planted: three
        # curated edges, all redundant; both totals off; fifteen declared edges,
        # three of them not in the catalog.
        "(VALUES ('clean', 'PASS', CAST(14 AS BIGINT), CAST(0 AS BIGINT)), "
        "('planted', 'FAIL', CAST(20 AS BIGINT), CAST(8 AS BIGINT)), "
        # Nothing declared, and no curated edge that is derived as well.
        "('undeclared', 'SKIP', CAST(0 AS BIGINT), CAST(0 AS BIGINT))) AS s(side, status, checked, failed), "
        "(SELECT CAST(sum(compared) AS BIGINT) AS compared FROM audit) AS c",
    ),
)
def check_edge_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared against derived and curated edges; then with entries added to both lists."""
    known = {"constraints": len(star.DECLARED), "composites": 1}
    columns = catalog(spark)
    # A reversed edge and edges to nowhere are declared; the curated list repeats
    # itself and what is declared.
    wrong = star.DECLARED + (_REVERSED,) + _BROKEN
    classified = rel.classify_keys(columns)
    clean = checks.foreign_key_oracle(
        columns, classified, rel.edge_frame(spark, star.DECLARED), rel.edge_frame(spark, star.CURATED), known
    )
    faulty = checks.foreign_key_oracle(
        columns, classified, rel.edge_frame(spark, wrong), rel.edge_frame(spark, _LISTED), known
    )
    undeclared = checks.foreign_key_oracle(columns, classified, None, rel.edge_frame(spark, star.CURATED), known)
    skipped = assertions.summarise(undeclared, ["foreign_key_oracle"]).withColumn("side", F.lit("undeclared"))
    compared = evidence(spark, sf_dir, star.DECLARED + star.CURATED).agg(F.sum("compared").alias("compared"))
    of_check = compared.select(F.lit("foreign_key_oracle").alias("check_name"), "compared")
    sides = verdicts("foreign_key_oracle", clean, faulty)
    return sides.unionByName(skipped.select(sides.columns)).join(of_check, "check_name").select(
        "side", "check_name", "status", "checked", "failed", "compared"
    )


@query(
    "check_referential",
    over(
        *_tables(ALL_EDGES),
        also={"stray": planted.plant_sql("dim_order", planted.STRAY_CUSTOMERS)},
        body=verdict_sql(
            "referential_integrity",
            str(len(ALL_EDGES)),
            {
                "clean": f"(SELECT count(*) FROM ({rows_sql([edge_sql(e) for e in ALL_EDGES])}) "
                "WHERE orphan_keys > 0 OR target_surplus > 0)",
                "planted": "(SELECT count(*) FROM ("
                + rows_sql([edge_sql(e, *("stray" if t == "dim_order" else None for t in (e[0], e[2]))) for e in ALL_EDGES])
                + ") WHERE orphan_keys > 0 OR target_surplus > 0)",
            },
        ),
    ),
)
def check_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edges of the union; then with customers that do not exist."""
    classified = rel.classify_keys(catalog(spark))
    clean = keys.edge_audit(star.frames(spark, sf_dir, _tables(ALL_EDGES)), ALL_EDGES)
    stray = keys.edge_audit(stray_frames(spark, sf_dir), ALL_EDGES)
    return verdicts(
        "referential_integrity",
        checks.referential_integrity(clean, classified),
        checks.referential_integrity(stray, classified),
    )


@query(
    "check_hierarchies",
    over(
        "dim_customer",
        also={"d": planted.plant_sql("dim_customer", planted.DANGLING)},
        body=verdict_sql(
            "hierarchies",
            "6",
            {
                "clean": "0",
                # The three planted cycle nodes, and the parents that do not exist.
                "planted": "1 + (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM d WHERE parent_customer_key < 0)",
            },
        ),
    ),
)
def check_hierarchies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer tree in two copies; then one copy with cycles and one with dangling parents."""
    customers = star.frame(spark, sf_dir, "dim_customer")
    edge = star.HIERARCHIES[0]
    two = [(name, edge[1], name, edge[3]) for name in ("first", "second")]
    clean = checks.hierarchies({"first": customers, "second": customers}, two)
    faulty = checks.hierarchies(
        {
            "first": planted.plant(customers, planted.CYCLES),
            "second": planted.plant(customers, planted.DANGLING),
        },
        two,
    )
    return verdicts("hierarchies", clean, faulty)


@query(
    "hierarchy_findings",
    over(
        "dim_customer",
        also={
            "d": planted.plant_sql("dim_customer", planted.DANGLING),
            "gone": "SELECT DISTINCT parent_customer_key AS k FROM d WHERE parent_customer_key NOT IN (SELECT customer_key FROM d)",
        },
        body="SELECT 'tree.parent_customer_key ' || what AS subject, CASE WHEN what <> 'dangling' OR n = 0 THEN '0' ELSE n || ', such as ' || shown END AS actual "
        "FROM (VALUES ('dangling'), ('conflicting'), ('cyclic')) AS w(what), (SELECT count(*) AS n FROM gone), "
        "(SELECT string_agg(k, ', ' ORDER BY k) AS shown FROM (SELECT k FROM gone ORDER BY k LIMIT 3))",
    ),
)
def hierarchy_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the check says of customers whose parents do not exist, with the first three."""
    tree = planted.plant(star.frame(spark, sf_dir, "dim_customer"), planted.DANGLING)
    edge = star.HIERARCHIES[0]
    return checks.hierarchies({"tree": tree}, [("tree", edge[1], "tree", edge[3])]).select("subject", "actual")


_COPIED = _ALL


@query(
    "check_copies_agree",
    over(
        "dim_customer",
        body=verdict_sql(
            "copies_agree",
            str(2 * len(_COPIED)),
            {"clean": "0", "planted": f"1 + (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim_customer WHERE {_LOST})"},
        ).replace(f"SELECT {2 * len(_COPIED)} AS checked, 1 +", f"SELECT {2 * len(_COPIED) + 1} AS checked, 1 +"),
    ),
)
def check_copies_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and copies count like the lake; then a copy lacks rows and a reader is gone."""
    source, root = fresh_database(spark, "original")
    views, _ = fresh_database(spark, "seen")
    copies, copied_to = fresh_database(spark, "copied")
    for t in _COPIED:
        with staging.passing(spark, sf_dir, t) as stored:
            lake.full_refresh(stored, source, t, root)
        lake.full_refresh(spark.table(lake.quoted(source, t)), copies, t, copied_to)
    lake.publish_views(spark, source, views)

    def counts(database: str, lossy: bool = False) -> DataFrame:
        frames = {t: spark.table(lake.quoted(database, t)) for t in _COPIED}
        if lossy:
            frames["dim_customer"] = frames["dim_customer"].where(f"NOT ({_LOST})")
        return profile.row_counts(frames)

    expected = counts(source)
    clean = checks.copies_agree({"view": lambda: counts(views), "copy": lambda: counts(copies)}, expected)
    faulty = checks.copies_agree(
        {
            "view": lambda: counts(views),
            "copy": lambda: counts(copies, lossy=True),
            "gone": lambda: counts("no_such_database"),
        },
        expected,
    )
    return verdicts("copies_agree", clean, faulty)


@query(
    "check_aggregates_agree",
    over(
        "fact_lineitem",
        also={"groups": "SELECT count(DISTINCT return_flag) AS n FROM fact_lineitem"},
        body=rows_sql(
            [
                "SELECT 'clean' AS side, 'aggregates_agree' AS check_name, 'PASS' AS status, CAST(2 * n AS BIGINT) AS checked, "
                "CAST(0 AS BIGINT) AS failed FROM groups",
                "SELECT 'planted', 'aggregates_agree', 'FAIL', CAST(2 * n AS BIGINT), CAST(n AS BIGINT) FROM groups",
            ]
        ),
    ),
)
def check_aggregates_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped sums from the original, the lake and a copy that spells numbers as text."""
    original = star.frame(spark, sf_dir, "fact_lineitem")
    stored = staging.scan(spark, sf_dir, "fact_lineitem")

    def totals(df: DataFrame) -> DataFrame:
        return profile.grouped_totals(df, "return_flag", "extended_price")

    def side(extra: str) -> DataFrame:
        spelled = text.stringified(totals(stored.withColumn("extended_price", F.expr(extra))))
        return checks.aggregates_agree(totals(original), {"lake": totals(stored), "text": spelled}, "return_flag")

    return verdicts("aggregates_agree", side("extended_price"), side("extended_price + 0.01BD"))


def _views(spark: SparkSession, stored: dict[str, str]) -> dict[str, partial[DataFrame]]:
    """Pass-through views of the stored tables, each as what opens it."""
    source, _ = fresh_database(spark, "registered")
    views, _ = fresh_database(spark, "viewed")
    spark.sql(f"CREATE DATABASE {lake.quoted(source)}")
    for t, path in stored.items():
        spark.sql(f"CREATE TABLE {lake.quoted(source, t)} USING parquet LOCATION '{path}'")
    lake.publish_views(spark, source, views)
    return {t: partial(spark.table, lake.quoted(views, t)) for t in stored}


def dataset(spark: SparkSession, sf_dir: str) -> verify.Dataset:
    """Extract, load, copy and view the whole star, ready to be verified."""
    stored = staging.stored_all(spark, sf_dir)
    return verify.Dataset(
        specs=star.SPECS,
        extracts={t: staging.extract(spark, sf_dir, t) for t in _ALL},
        stored=stored,
        known=_known(spark, sf_dir),
        curated=star.CURATED,
        declared=star.DECLARED,
        copies={"copy": staging.copied_all(spark, sf_dir, _ALL), "view": _views(spark, stored)},
    )


def _report_sql() -> str:
    texts = _texts(*_ALL)
    money = sum(c.sql_type == "money" for s in star.SPECS.values() for c in s.kept)
    checked = {
        "known_baseline": 3,
        "row_counts": len(_ALL),
        "types": _COLUMNS,
        "type_mapping": len(typing.GOLDEN_TYPES) + len({c.sql_type for s in star.SPECS.values() for c in s.kept}),
        "nullability_flags": _COLUMNS + _REQUIRED,
        "nullability_enforced": _GUARDED,
        "null_reconciliation": texts,
        "value_digests": _COLUMNS,
        "primary_keys": len(_OWN_KEYS),
        "foreign_key_oracle": 14,
        "hierarchies": 3,
        "decimal_exactness": money,
        "copies_agree": 2 * len(_ALL),
    }
    number = {c: str(n) for c, n in checked.items()}
    # Watched literals really present in the texts, per column.
    listed = ", ".join(f"'{t}'" for t in text.WATCHED_TOKENS)
    number["source_values"] = "(SELECT count(*) + 1 FROM tokens)"
    number["referential_integrity"] = str(len(ALL_EDGES))
    audit = rows_sql([edge_sql(e) for e in ALL_EDGES])
    own = rows_sql([f"SELECT count(*) - count(DISTINCT {k[0]}) AS surplus FROM {t}" for t, k in _OWN_KEYS])
    failed = {
        "referential_integrity": f"(SELECT count(*) FROM ({audit}) WHERE orphan_keys > 0 OR target_surplus > 0)",
        "primary_keys": f"(SELECT count(*) FROM ({own}) WHERE surplus > 0)",
    }
    tokens = rows_sql(
        [
            f"SELECT DISTINCT '{t}.{c.name}' AS col, {c.name} AS token FROM {t} WHERE {c.name} IN ({listed})"
            for t, s in star.SPECS.items()
            for c in s.kept
            if c.sql_type in ("nvarchar", "nchar")
        ]
    )
    rows = rows_sql(
        [
            f"SELECT {i} AS position, '{n}' AS check_name, CAST({number[n]} AS BIGINT) AS checked, "
            f"CAST({failed.get(n, '0')} AS BIGINT) AS failed"
            for i, n in enumerate(checks.NAMES, 1)
        ]
    )
    return over(
        *_ALL,
        also={"tokens": tokens, "r": rows},
        body="SELECT position, check_name, CASE WHEN checked = 0 THEN 'SKIP' WHEN failed > 0 THEN 'FAIL' ELSE 'PASS' END AS status, "
        "checked, failed, CASE WHEN checked = 0 THEN 'nothing to check' WHEN failed > 0 THEN failed || ' of ' || checked || ' failed' "
        "ELSE 'all ' || checked || ' hold' END AS detail FROM r",
    )


@query("verification_report", _report_sql())
def verification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract, load and verify all tables: one row per check."""
    found = verify.Verification(spark, dataset(spark, sf_dir)).assertions()
    return verify.report(found).orderBy("position")


_UNUSED_TYPES = sorted({g[0] for g in typing.GOLDEN_TYPES} - {c.sql_type for s in star.SPECS.values() for c in s.kept})


@query(
    "verification_notes",
    over(
        *_tables(ALL_EDGES),
        also={"audit": rows_sql([edge_sql(e) for e in ALL_EDGES])},
        body="SELECT 'type_mapping' AS check_name, sql_type AS subject, 'no column of this type' AS note FROM "
        + values_sql("sql_type", [(t,) for t in _UNUSED_TYPES])
        + " UNION ALL SELECT 'referential_integrity', 'coverage', CAST(sum(compared) AS BIGINT) || ' values compared over ' || count(*) || ' edges' FROM audit "
        "UNION ALL SELECT 'referential_integrity', edge, 'nothing to compare' FROM audit WHERE compared = 0 "
        "UNION ALL SELECT 'foreign_key_oracle', verdict, n || ' edges' FROM "
        + values_sql("verdict, n", [(v, sum(v == w for _, w in _VERDICTS)) for v in ("agreed", "routed", "missed", "invented")]),
    ),
)
def verification_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands behind the checks that pass: unused types, values compared, declared against derived edges."""
    return verify.Verification(spark, dataset(spark, sf_dir)).notes()
