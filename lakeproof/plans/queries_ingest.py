"""Queries: scans, casts, text rules, writes, copies, views, SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeproof.functions import text
from lakeproof.functions.digest import digest, digest_parts, value_hash
from lakeproof.functions.sqltext import name
from lakeproof.operators import profile
from lakeproof.operators.profile import union_all
from lakeproof.plans import checks, planted, staging, star
from lakeproof.plans.registry import over, query, rows_sql, values_sql
from lakeproof.session import local_frame, new_scratch
from lakeproof.sources import delimited, lake, specs

MD5_SQL = "CAST(coalesce(sum(CAST(CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 15) AS BIGINT) AS DECIMAL(38,0))), 0) AS DECIMAL(38,0))"


def portable_digest(column: str, of) -> str:
    return digest(*digest_parts(value_hash(column, of, portable=True)))


def money(total: str) -> str:
    return f"CAST(coalesce(sum({total}), 0) AS DECIMAL(38,4))"


def fresh_database(spark: SparkSession, label: str) -> tuple[str, str]:
    """A database nobody else uses, and the folder its tables go to."""
    path = new_scratch(spark, label)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


@query(
    "scan_pinned_csv",
    over(
        "dim_order",
        body="SELECT count(*) AS rows, CAST(sum(total_price) AS DECIMAL(38,4)) AS total, min(order_date) AS first_date, "
        f"max(order_date) AS last_date, {MD5_SQL.format('order_key')} AS key_digest FROM dim_order",
    ),
)
def scan_pinned_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = star.SPECS["dim_order"]
    orders = delimited.pinned_scan(spark, staging.extract(spark, sf_dir, "dim_order"), spec)
    return orders.selectExpr(
        "count(1) AS rows",
        f"{money('total_price')} AS total",
        "min(order_date) AS first_date",
        "max(order_date) AS last_date",
        f"{portable_digest('order_key', orders.schema['order_key'].dataType)} AS key_digest",
    )


def planted_extract(spark: SparkSession, sf_dir: str, table: str, defect: dict[str, str]) -> str:
    df = planted.plant(star.frame(spark, sf_dir, table), defect)
    return delimited.write_extract(df, new_scratch(spark, f"planted-{table}"), star.SPECS[table])


@query(
    "scan_multi_line",
    over(
        "fact_conversation",
        body="SELECT count(*) AS rows, CAST(sum(length(m)) AS BIGINT) AS chars, count(*) FILTER (contains(m, chr(10))) AS broken, "
        f"{MD5_SQL.format('m')} AS digest FROM (SELECT coalesce(role_name || ' \"said\"' || chr(10) || chr(13) || chr(10) || ',' || message_text, '') AS m FROM fact_conversation)",
    ),
)
def scan_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with quotes, commas and line breaks inside, from an extract that any number of tasks may split."""
    table = "fact_conversation"
    broken = "concat(role_name, ' \"said\"', char(10), char(13), char(10), ',', message_text)"
    df = star.frame(spark, sf_dir, table).withColumn("message_text", F.expr(broken))
    path = delimited.write_extract(df, new_scratch(spark, "multi-line"), star.SPECS[table])
    scan = delimited.text_columns(spark, path, star.SPECS[table])
    return scan.selectExpr(
        "count(1) AS rows",
        "sum(char_length(message_text)) AS chars",
        "count_if(contains(message_text, char(10))) AS broken",
        f"{portable_digest('message_text', scan.schema['message_text'].dataType)} AS digest",
    )


_CUSTOMER_COLUMNS = [c.name for c in star.SPECS["dim_customer"].kept]


@query(
    "scan_raw_text",
    over(
        "dim_customer",
        also={"planted": planted.plant_sql("dim_customer", planted.SEGMENTS)},
        body=rows_sql(
            [
                f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (coalesce(CAST({c} AS VARCHAR), '') = '') "
                "AS empties FROM planted"
                for c in _CUSTOMER_COLUMNS
            ]
        ),
    ),
)
def scan_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = planted_extract(spark, sf_dir, "dim_customer", planted.SEGMENTS)
    raw = delimited.text_columns(spark, path, star.SPECS["dim_customer"])
    counted = raw.selectExpr("count(1) AS rows", *[f"count_if({name(c)} = '') AS {name(c)}" for c in raw.columns])
    return counted.unpivot("rows", raw.columns, "column_name", "empties").select("column_name", "rows", "empties")


@query(
    "empty_to_null",
    over(
        "dim_customer",
        also={"planted": planted.plant_sql("dim_customer", planted.SEGMENTS)},
        body="SELECT count(*) AS rows, count(*) FILTER (market_segment = '') AS nulls, "
        "count(*) FILTER (market_segment IN ('NA', 'null')) AS kept_tokens FROM planted",
    ),
)
def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = planted_extract(spark, sf_dir, "dim_customer", planted.SEGMENTS)
    loaded = delimited.pinned_scan(spark, path, star.SPECS["dim_customer"])
    return loaded.selectExpr(
        "count(1) AS rows",
        "count_if(market_segment IS NULL) AS nulls",
        "count_if(market_segment IN ('NA', 'null')) AS kept_tokens",
    )


def drift_sql(table: str) -> str:
    """Guessed types told from the stored values of a table: whole numbers by size, decimals as fractions, times by their clock."""
    guesses = {
        T.IntegerType: "'int'",
        T.LongType: "CASE WHEN max(abs({c})) > 2147483647 THEN 'bigint' ELSE 'int' END",
        T.DecimalType: "'double'",
        T.DoubleType: "'double'",
        T.DateType: "'date'",
        T.TimestampNTZType: "'timestamp'",
        T.BooleanType: "'int'",
        T.StringType: "'string'",
    }
    parts = []
    for c in star.SPECS[table].kept:
        filled = f"count(*) FILTER (CAST({c.name} AS VARCHAR) <> '')"
        guess = f"CASE WHEN {filled} = 0 THEN 'string' ELSE {guesses[type(c.stored)].format(c=c.name)} END"
        parts.append(f"SELECT '{table}' AS table_name, '{c.name}' AS column_name, {guess} AS inferred, '{c.stored.simpleString()}' AS pinned, {filled} AS cells FROM {table}")
    return rows_sql(parts)


DRIFT_TABLES = ["dim_order", "dim_customer", "fact_lineitem"]


@query(
    "schema_drift",
    over(*DRIFT_TABLES, body=f"SELECT * FROM ({rows_sql([drift_sql(t) for t in DRIFT_TABLES])}) WHERE inferred <> pinned"),
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns a guess would type differently, and how many values that touches; one scan a table."""
    return union_all(
        [
            delimited.schema_drift(spark, staging.extract(spark, sf_dir, t), star.SPECS[t]).selectExpr(
                f"'{t}' AS table_name", "column_name", "inferred", "pinned", "cells"
            )
            for t in DRIFT_TABLES
        ]
    )


@query(
    "convert_delimited",
    over(
        "dim_supplier",
        body="SELECT count(*) AS rows, count(*) FILTER (account_balance < 0 OR nation_key = 7) AS ragged, "
        "count(*) AS quoted, CAST(sum(supplier_key) AS BIGINT) AS key_total FROM dim_supplier",
    ),
)
def convert_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-separated suppliers, some short, some long, some followed by a blank line, to CSV."""
    suppliers = star.frame(spark, sf_dir, "dim_supplier")
    line = (
        "concat_ws('|', supplier_key, concat(supplier_alternate_key, ', \"Co\"'), nation_key, "
        "CASE WHEN account_balance >= 0 THEN account_balance END, "
        "CASE WHEN nation_key = 7 THEN if(account_balance < 0, 'x|y', 'x') END)"
    )
    lines = suppliers.selectExpr(f"inline(array(struct({line}), struct(if(nation_key = 3, '', NULL))))")
    source = new_scratch(spark, "piped")
    lines.toDF("value").where("value IS NOT NULL").write.text(source)
    header = [c.source_name for c in star.SPECS["dim_supplier"].columns]
    target = delimited.convert_delimited(spark, source, new_scratch(spark, "converted"), header)
    audit = delimited.ragged_rows(spark, target, header)
    key, name_, *_ = header
    read_back = delimited.parsed_rows(spark, target, header).selectExpr(
        f"count_if(endswith({name(name_)}, ', \"Co\"')) AS quoted",
        f"sum(CAST({name(key)} AS BIGINT)) AS key_total",
    )
    both = audit.unionByName(read_back, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("rows", "ragged", "quoted", "key_total")])


@query(
    "ragged_rows",
    over(
        "dim_order",
        body="SELECT order_status, count(*) AS rows, count(*) FILTER (order_priority IN ('1-URGENT', '5-LOW')) AS ragged "
        "FROM dim_order GROUP BY order_status",
    ),
)
def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order status; urgent orders lost a field, low ones gained one."""
    header = ["OrderKey", "OrderStatus", "TotalPrice", "OrderPriority"]
    line = (
        "concat_ws('|', order_key, order_status, total_price, CASE WHEN order_priority <> '1-URGENT' THEN order_priority END, "
        "CASE WHEN order_priority = '5-LOW' THEN 'extra' END)"
    )
    orders = star.frame(spark, sf_dir, "dim_order").selectExpr("order_status", f"{line} AS value")
    source = new_scratch(spark, "ragged")
    orders.write.partitionBy("order_status").text(source)
    out = []
    for status in ("F", "O", "P"):
        target = delimited.convert_delimited(
            spark, f"{source}/order_status={status}", new_scratch(spark, "ragged-csv"), header
        )
        out.append(delimited.ragged_rows(spark, target, header).select(F.lit(status).alias("order_status"), "rows", "ragged"))
    return union_all(out)


@query(
    "scan_table",
    over(
        "fact_lineitem",
        body="SELECT count(*) AS rows, CAST(sum(extended_price) AS DECIMAL(38,4)) AS total, "
        "count(DISTINCT return_flag) AS flags, max(ship_date) AS last_ship FROM fact_lineitem",
    ),
)
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.scan(spark, sf_dir, "fact_lineitem").selectExpr(
        "count(1) AS rows",
        f"{money('extended_price')} AS total",
        "count(DISTINCT return_flag) AS flags",
        "max(ship_date) AS last_ship",
    )


def _total(df: DataFrame, side: str, column: str = "account_balance") -> DataFrame:
    return df.selectExpr(f"'{side}' AS side", "count(1) AS rows", f"{money(column)} AS total")


_TWICE = "SELECT {} AS side, count(*) AS rows, CAST(sum(account_balance) AS DECIMAL(38,4)) AS total FROM dim_customer"


@query("full_refresh", over("dim_customer", body=rows_sql([_TWICE.format("'first'"), _TWICE.format("'second'")])))
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading a table twice leaves it as loading it once."""
    database, root = fresh_database(spark, "refresh")
    customers = star.frame(spark, sf_dir, "dim_customer")
    lake.full_refresh(customers, database, "dim_customer", root)
    first = spark.table(lake.quoted(database, "dim_customer"))
    # Materialised now: the second refresh removes the files this frame reads.
    kept = local_frame(spark, [tuple(r) for r in _total(first, "first").collect()], "side string, rows bigint, total decimal(38,4)")
    lake.full_refresh(customers, database, "dim_customer", root)
    return kept.unionAll(_total(spark.table(lake.quoted(database, "dim_customer")), "second"))


@query("copy_refresh", over("dim_customer", body=rows_sql([_TWICE.format("'lake'"), _TWICE.format("'copy'")])))
def copy_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full-refresh copy of a lake table in a second database, guard included."""
    database, root = fresh_database(spark, "copy")
    customers = staging.scan(spark, sf_dir, "dim_customer")
    lake.full_refresh(customers, database, "dim_customer", root)
    return _total(customers, "lake").unionAll(_total(spark.table(lake.quoted(database, "dim_customer")), "copy"))


_COPY_SQL = {
    "bit": "boolean", "tinyint": "integer", "smallint": "integer", "int": "integer", "bigint": "bigint",
    "float": "double precision", "money": "numeric(19,4)", "date": "date", "datetime": "timestamp",
    "nvarchar": "text", "nchar": "text",
}


@query(
    "copy_type_map",
    over(
        *star.TABLES,
        body=rows_sql(
            [
                f"SELECT '{t}' AS table_name, v.column_name, v.copy_type, r.rows FROM "
                + values_sql("column_name, copy_type", [(c.name, _COPY_SQL[c.sql_type]) for c in s.kept])
                + f", (SELECT count(*) AS rows FROM {t}) r"
                for t, s in star.SPECS.items()
            ]
        ),
    ),
)
def copy_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = star.frames(spark, sf_dir)
    kept = {t: df.select(*[c.name for c in star.SPECS[t].kept]) for t, df in frames.items()}
    return lake.copy_types(spark, kept).join(profile.row_counts(frames), "table_name")


_LOADED = star.TABLES


@query(
    "load_run_log",
    over(
        *_LOADED,
        body=rows_sql(
            [f"SELECT 'lakeproof' AS loader, '{t}' AS table_name, count(*) AS rows, true AS loaded FROM {t}" for t in _LOADED]
            + ["SELECT 'lakeproof', 'dim_customer without balance', NULL, false"]
        ),
    ),
)
def load_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several loads, one of which violates its NOT NULL; the others go on."""
    root = new_scratch(spark, "loads")
    strict = specs.TableSpec(
        "dbo.DimCustomer",
        "dim_customer",
        tuple(
            specs.PinnedColumn(c.source_name, c.name, c.sql_type, nullable=False)
            for c in star.SPECS["dim_customer"].columns
        ),
    )

    def load(table: str) -> DataFrame:
        path = staging.load_into(spark, sf_dir, table, f"{root}/{table}")
        return spark.read.schema(star.SPECS[table].stored_schema).parquet(path)

    def load_strict() -> DataFrame:
        path = planted_extract(spark, sf_dir, "dim_customer", {"account_balance": "CAST(NULL AS DECIMAL(19,4))"})
        delimited.pinned_scan(spark, path, strict).write.parquet(f"{root}/strict")
        return spark.read.parquet(f"{root}/strict")

    loads = {t: lambda t=t: load(t) for t in _LOADED} | {"dim_customer without balance": load_strict}
    log = lake.load_tables(spark, "lakeproof", loads)
    return log.select("loader", "table_name", "rows", F.col("error").isNull().alias("loaded"))


@query(
    "run_summary",
    over(
        "fact_event",
        also={
            "loads": "SELECT event_type AS loader, CAST(event_time AS DATE) AS run_id, user_id, "
            "CAST(event_value AS DECIMAL(18,4)) AS seconds FROM fact_event",
            "runs": "SELECT loader, run_id, count(*) AS loads, count(DISTINCT user_id) AS rows, sum(seconds) AS seconds, "
            "max(seconds) AS wall FROM loads GROUP BY loader, run_id",
        },
        body="SELECT loader, count(*) AS runs, CAST(sum(loads) // count(*) AS BIGINT) AS tables_per_run, "
        "arg_min(rows, run_id) AS rows, "
        "CAST(floor(sum(wall) * 100 / count(*)) AS BIGINT) AS avg_wall_cents, "
        "CAST(floor(sum(seconds) * 100 / count(*)) AS BIGINT) AS avg_table_cents FROM runs GROUP BY loader",
    ),
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a log of loads: a run is a day, its wall clock the longest load."""
    loads = star.frame(spark, sf_dir, "fact_event").selectExpr(
        "event_type AS loader",
        "CAST(event_time AS DATE) AS run_id",
        "user_id",
        "CAST(event_value AS DECIMAL(18,4)) AS seconds",
    )
    tables = loads.selectExpr("loader", "run_id", "CAST(user_id AS STRING) AS table_name", "1L AS rows", "seconds")
    # One row per user and run first, so that a busy run is not counted in one task.
    per_user = loads.groupBy("loader", "run_id", "user_id").agg(F.max("seconds").alias("seconds"))
    walls = per_user.groupBy("loader", "run_id").agg(
        F.lit("__total__").alias("table_name"), F.count(F.lit(1)).alias("rows"), F.max("seconds").alias("seconds")
    )
    summary = lake.run_summary(tables.unionByName(walls))
    cents = lambda c: F.floor(F.col(c) * 100).cast("bigint")
    return summary.select(
        "loader",
        "runs",
        "tables_per_run",
        "rows",
        cents("avg_wall").alias("avg_wall_cents"),
        cents("avg_table_seconds").alias("avg_table_cents"),
    )


_VIEWED = star.TABLES


def published(spark: SparkSession, sf_dir: str, label: str, tables: tuple[str, ...] = _VIEWED) -> str:
    """The stored tables registered in a database of their own."""
    database, _ = fresh_database(spark, label)
    spark.sql(f"CREATE DATABASE {lake.quoted(database)}")
    for t, path in staging.stored_all(spark, sf_dir, tables).items():
        columns = ", ".join(f"{name(f.name)} {f.dataType.simpleString()}" for f in star.SPECS[t].stored_schema.fields)
        spark.sql(f"CREATE TABLE {lake.quoted(database, t)} ({columns}) USING parquet LOCATION '{path}'")
    return database


@query(
    "passthrough_views",
    over(
        *_VIEWED,
        body=rows_sql(
            [
                f"SELECT '{t}' AS view_name, {len(star.SPECS[t].kept)} AS n_columns, count(*) AS rows FROM {t}"
                for t in _VIEWED
            ]
        ),
    ),
)
def passthrough_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = published(spark, sf_dir, "raw")
    views, _ = fresh_database(spark, "views")
    made = lake.publish_views(spark, source, views)
    counted = profile.row_counts({t: spark.table(lake.quoted(views, t)) for t in _VIEWED})
    return made.join(counted.withColumnRenamed("table_name", "view_name"), "view_name")


@query(
    "list_tables",
    over(
        *_VIEWED,
        body=rows_sql([f"SELECT 'listed' AS schema_name, '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _VIEWED]),
    ),
)
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = published(spark, sf_dir, "listed")
    listed = lake.list_tables(spark, database)
    counted = profile.row_counts({t: spark.table(lake.quoted(database, t)) for t in _VIEWED})
    return listed.join(counted, "table_name").select(_label("schema_name").alias("schema_name"), "table_name", "rows")


def _label(column: str) -> Column:
    """The name of a database without what makes it nobody else's."""
    return F.regexp_replace(column, "_[0-9a-f]{32}$", "")


@query(
    "list_schemas",
    over(
        "dim_nation", "dim_order",
        body="SELECT schema_name, tables, rows FROM (VALUES ('first', 1), ('second', 2)) AS s(schema_name, tables), "
        "(SELECT count(*) AS n FROM dim_nation), (SELECT count(*) AS o FROM dim_order), "
        "LATERAL (SELECT CAST(CASE schema_name WHEN 'first' THEN n ELSE n + o END AS BIGINT) AS rows)",
    ),
)
def list_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two databases found in the listing, with their tables and rows; a third is dropped and not listed."""
    made = {
        published(spark, sf_dir, label, tables): tables
        for label, tables in (("first", ("dim_nation",)), ("second", ("dim_nation", "dim_order")), ("third", ("dim_nation",)))
    }
    spark.sql(f"DROP DATABASE {lake.quoted(list(made)[2])} CASCADE")
    here = lake.list_schemas(spark).where(F.col("schema_name").isin(*made))
    found = [(s, r.table_name) for s in (r.schema_name for r in here.collect()) for r in lake.list_tables(spark, s).collect()]
    counted = profile.row_counts({f"{s}.{t}": spark.table(lake.quoted(s, t)) for s, t in found})
    schema = F.substring_index("table_name", ".", 1)
    per_schema = counted.groupBy(schema.alias("schema_name")).agg(F.count(F.lit(1)).cast("int").alias("tables"), F.sum("rows").alias("rows"))
    return here.join(per_schema, "schema_name").select(_label("schema_name").alias("schema_name"), "tables", "rows")


_PARAM_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag"


@query(
    "param_sql",
    f"SELECT {_PARAM_COLUMNS} FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R' "
    f"ORDER BY {_PARAM_COLUMNS} LIMIT 100",
)
def param_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prepared statement over the whole table; the row cap is the feature."""
    view = fresh_database(spark, "lineitem")[0]
    star.base(spark, sf_dir, "lineitem").createOrReplaceTempView(view)
    sql = f"SELECT {_PARAM_COLUMNS} FROM {view} WHERE l_quantity > ? AND l_returnflag = ? ORDER BY {_PARAM_COLUMNS}"
    return lake.param_sql(spark, sql, [45, "R"], limit=100)


@query(
    "report_sink",
    over(
        "fact_lineitem",
        also={"t": "SELECT return_flag, count(*) AS n, sum(extended_price) AS total FROM fact_lineitem GROUP BY return_flag"},
        body=rows_sql(
            [
                f"SELECT '{f}' AS format, return_flag, n, CAST(total AS DECIMAL(38,4)) AS total FROM t"
                for f in ("csv", "json")
            ]
        ),
    ),
)
def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as CSV and as JSON, and both read back."""
    report = profile.grouped_totals(star.frame(spark, sf_dir, "fact_lineitem"), "return_flag", "extended_price")
    csv_path, json_path = lake.write_report(report, new_scratch(spark, "report"))
    schema = "return_flag string, n bigint, total decimal(38,4)"
    from_csv = spark.read.schema(schema).csv(csv_path, header=True)
    from_json = spark.read.schema(schema).json(json_path)
    columns = ["return_flag", "n", "total"]
    return from_csv.select(F.lit("csv").alias("format"), *columns).unionAll(
        from_json.select(F.lit("json").alias("format"), *columns)
    )


@query(
    "strip_nul",
    over(
        "dim_part",
        also={
            "planted": planted.plant_sql("dim_part", planted.NUL_NAMES),
            "stripped": "SELECT replace(part_name, chr(0), '') AS part_name FROM planted",
        },
        body="SELECT count(*) AS rows, count(*) FILTER (part_name = '') AS empties, "
        "count(*) FILTER (contains(part_name, chr(0))) AS nul_left, count(*) FILTER (part_name IS NULL) AS nulls, "
        f"{MD5_SQL.format('part_name')} AS digest FROM stripped",
    ),
)
def strip_nul(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with NUL bytes through an extract and the pinned scan."""
    path = planted_extract(spark, sf_dir, "dim_part", planted.NUL_NAMES)
    spec = star.SPECS["dim_part"]
    relaxed = specs.TableSpec(
        spec.source_table, spec.table, tuple(specs.PinnedColumn(c.source_name, c.name, c.sql_type) for c in spec.columns)
    )
    loaded = delimited.pinned_scan(spark, path, relaxed)
    return loaded.selectExpr(
        "count(1) AS rows",
        "count_if(part_name = '') AS empties",
        "count_if(contains(part_name, char(0))) AS nul_left",
        "count_if(part_name IS NULL) AS nulls",
        f"{portable_digest('part_name', loaded.schema['part_name'].dataType)} AS digest",
    )


def hashable(spec: specs.TableSpec) -> dict[str, str]:
    """Columns in a form whose text is the same everywhere: doubles as decimals."""
    return {
        c.name: f"CAST({name(c.name)} AS DECIMAL(19,4))" if c.sql_type == "float" else name(c.name) for c in spec.kept
    }


def hashable_sql(table: str) -> str:
    return ", ".join(
        f"CAST({c.name} AS DECIMAL(19,4)) AS {c.name}" if c.sql_type == "float" else c.name
        for c in star.SPECS[table].kept
    )


@query(
    "cast_pinned",
    over(
        "fact_lineitem",
        also={"h": f"SELECT {hashable_sql('fact_lineitem')} FROM fact_lineitem"},
        body=rows_sql(
            [
                f"SELECT '{c.name}' AS column_name, '{c.stored.simpleString()}' AS stored_type, "
                f"count(*) FILTER ({c.name} IS NULL) AS nulls, {MD5_SQL.format(c.name)} AS digest FROM h"
                for c in star.SPECS["fact_lineitem"].kept
            ]
        ),
    ),
)
def cast_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as text, cast back to its pinned types."""
    spec = star.SPECS["fact_lineitem"]
    raw = star.frame(spark, sf_dir, "fact_lineitem").selectExpr(
        *specs.projection({c.name: f"coalesce({delimited.as_text(c)}, '')" for c in spec.kept})
    )
    pinned = delimited.pin(raw, spec)
    stored = local_frame(
        spark, [(f.name, f.dataType.simpleString()) for f in pinned.schema.fields], "column_name string, stored_type string"
    )
    comparable = pinned.selectExpr(*specs.projection(hashable(spec)))
    digests = profile.column_digests(comparable, "lake", spec.table, portable=True)
    wide = digests.where("column_name <> '*'").groupBy("column_name").pivot("metric", ["nulls", "digest"]).agg(F.max("value"))
    return stored.join(wide, "column_name").select(
        "column_name", "stored_type", F.col("nulls").cast("bigint"), F.col("digest").cast("decimal(38,0)")
    )


_SPELLED = {
    "extended_price": "CAST(extended_price AS {})",
    "quantity": "CAST(quantity AS {})",
    "discount_pct": "CAST(discount_pct AS {})",
    "return_flag": "return_flag",
}
_COMPARABLE_SQL = "coalesce(CAST(CAST(round(TRY_CAST(v AS DECIMAL(38,4)), 2) AS DECIMAL(38,2)) AS VARCHAR), v)"


@query(
    "normalise_values",
    over(
        "fact_lineitem",
        also={
            "spelled": rows_sql(
                [f"SELECT '{c}' AS column_name, {e.format('VARCHAR')} AS v FROM fact_lineitem" for c, e in _SPELLED.items()]
            )
        },
        body=f"SELECT column_name, {_COMPARABLE_SQL} AS value, count(*) AS n FROM spelled GROUP BY 1, 2",
    ),
)
def normalise_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as every reader spells them, brought to two decimals."""
    spelled = star.frame(spark, sf_dir, "fact_lineitem").selectExpr(
        *specs.projection({c: e.format("STRING") for c, e in _SPELLED.items()})
    )
    long = spelled.unpivot([], list(_SPELLED), "column_name", "v")
    return long.groupBy("column_name", text.comparable(F.col("v")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "stringify",
    over(
        "dim_order",
        also={
            "s": "SELECT order_key, customer_key, order_date_key, order_status, CAST(total_price AS VARCHAR) AS total_price, "
            "CAST(order_date AS VARCHAR) AS order_date, order_priority FROM dim_order"
        },
        body="SELECT order_priority, max(total_price) AS total_price, max(order_date) AS order_date, "
        "max(order_key) AS order_key, count(*) AS n FROM s GROUP BY order_priority",
    ),
)
def stringify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals and dates become text; the maxima are those of the text."""
    as_text = text.stringified(star.frame(spark, sf_dir, "dim_order"))
    return as_text.groupBy("order_priority").agg(
        F.max("total_price").alias("total_price"),
        F.max("order_date").alias("order_date"),
        F.max("order_key").alias("order_key"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "enforce_not_null",
    over(
        "fact_lineitem",
        body="SELECT 'clean' AS case_name, 'accepted' AS outcome, true AS required, count(*) AS rows FROM fact_lineitem "
        "UNION ALL SELECT 'planted', 'USER_RAISED_EXCEPTION', true, count(*) FROM fact_lineitem",
    ),
)
def enforce_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price guarded; then the same with the returned lines' prices missing."""
    spec = star.SPECS["fact_lineitem"]
    price = next(c for c in spec.kept if c.name == "extended_price")
    lines = star.frame(spark, sf_dir, "fact_lineitem")
    rows = []
    for case, value in (
        ("clean", "extended_price"),
        ("planted", "CASE WHEN return_flag <> 'R' THEN extended_price END"),
    ):
        guarded = lines.selectExpr(f"{specs.guarded(spec, price, value)} AS extended_price")
        outcome = checks.runs_clean(guarded) or "accepted"
        rows.append((case, outcome, not guarded.schema["extended_price"].nullable))
    cases = local_frame(spark, rows, "case_name string, outcome string, required boolean")
    counted = profile.row_counts({"clean": lines, "planted": lines}).withColumnRenamed("table_name", "case_name")
    return cases.join(counted, "case_name")


_PASCAL = "concat(replace(initcap(part_name), ' ', ''), 'PO', initcap(lower(part_type)), '{}')"


@query(
    "snake_case_names",
    over(
        "dim_part",
        also={
            "words": "SELECT split_part(part_name, ' ', 1) AS a, split_part(part_name, ' ', 2) AS b, lower(part_type) AS c, "
            "brand_name FROM dim_part",
            "named": "SELECT upper(a[1]) || a[2:] || upper(b[1]) || b[2:] || 'PO' || upper(c[1]) || c[2:] || 'Key' AS source_name, "
            "a || '_' || b || '_po_' || c || '_key' AS name FROM words",
        },
        body="SELECT source_name, name, count(*) AS n FROM named GROUP BY source_name, name",
    ),
)
def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers like RedWidgetPOEconomyKey made from the parts, and normalised."""
    parts = star.frame(spark, sf_dir, "dim_part").selectExpr(f"{_PASCAL.format('Key')} AS source_name")
    counted = parts.groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("source_name", text.snake_case(F.col("source_name")).alias("name"), "n")
