"""Lake tables: full refresh, guarded scans, batch loads, views, copies, SQL."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeproof.functions import typing
from lakeproof.functions.sqltext import name
from lakeproof.sources import specs
from lakeproof.sources.specs import TableSpec
from lakeproof.session import local_frame, remove

COPY_BATCH_ROWS = 50_000

RUN_LOG = "loader string, table_name string, rows bigint, seconds double, error string"


def quoted(*parts: str) -> str:
    return ".".join(name(p) for p in parts)


def scan(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """A lake table under its pinned schema.

    File tables forget NOT NULL, so the guard is put back on the way out.
    """
    stored = spark.read.schema(spec.stored_schema).parquet(path)
    return stored.selectExpr(*specs.projection({c.name: specs.guarded(spec, c, name(c.name)) for c in spec.kept}))


def location(spark: SparkSession, database: str, table: str) -> str | None:
    """The folder a catalog table lies in; None if there is no such table or it is a view."""
    full = quoted(database, table)
    if not spark.catalog.tableExists(full):
        return None
    row = spark.sql(f"DESCRIBE FORMATTED {full}").where(F.col("col_name") == "Location").first()
    return row and row.data_type


def full_refresh(df: DataFrame, database: str, table: str, root: str) -> str:
    """Replace a lake table by ``df``; returns the folder that now holds it.

    The data is written to a new folder first and the table is re-pointed only
    after the write succeeded: a failed load leaves the old content in place and
    no folder of its own, and running it again gives the same table. While the
    columns stay the same the table never ceases to exist. The folder before
    this one stays for readers that are under way; the one before that goes.
    One table is refreshed by one job at a time.
    """
    spark = df.sparkSession
    full = quoted(database, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    path = f"{root.rstrip('/')}/{table}/v-{uuid4().hex}"
    try:
        df.write.parquet(path)
    except Exception:
        remove(spark, path)
        raise
    previous = location(spark, database, table)
    wanted = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if previous and [(f.name, f.dataType.simpleString()) for f in spark.table(full).schema.fields] == wanted:
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        spark.catalog.refreshTable(full)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        columns = ", ".join(f"{quoted(c)} {of}" for c, of in wanted)
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet LOCATION '{path}'")
    _remove_versions(spark, f"{root.rstrip('/')}/{table}", keep=(path, previous))
    return path


def _remove_versions(spark: SparkSession, folder: str, keep: tuple[str | None, ...]) -> None:
    """Delete the versions of a table below its folder, but for those in ``keep``."""
    kept = {k.rsplit("/", 1)[1] for k in keep if k}
    parent = spark._jvm.org.apache.hadoop.fs.Path(folder)
    for status in parent.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(parent):
        version = status.getPath().getName()
        if version.startswith("v-") and version not in kept:
            remove(spark, f"{folder}/{version}")


def load_tables(
    spark: SparkSession, loader: str, loads: dict[str, Callable[[], DataFrame]], parallel: int = 4
) -> DataFrame:
    """Run independent loads, keep going on failure, report one row per table.

    Each load writes a table and returns the frame to read it back with; the
    row count comes from the stored data, not from what was meant to be
    written. Loads overlap so that small tables do not leave the cluster idle.
    """

    def run(table: str) -> tuple:
        start = time.perf_counter()
        try:
            rows, error = loads[table]().count(), None
        except Exception as exc:  # reported per table, all at the end
            rows, error = None, f"{type(exc).__name__}: {str(exc).splitlines()[0]}"
        return loader, table, rows, time.perf_counter() - start, error

    with ThreadPoolExecutor(parallel) as pool:
        return local_frame(spark, list(pool.map(run, loads)), RUN_LOG)


def copy_types(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, copy_type) for a relational copy."""
    rows = [(t, f.name, typing.copy_type(f.dataType)) for t, df in frames.items() for f in df.schema.fields]
    return local_frame(spark, rows, "table_name string, column_name string, copy_type string")


def jdbc_options(properties: dict[str, str] | None = None, connections: int = 16) -> dict[str, str]:
    """Writer options: rows per batch, and no more connections than the store can bear."""
    return {"batchsize": str(COPY_BATCH_ROWS), "numPartitions": str(connections), **(properties or {})}


@dataclass(frozen=True)
class RelationalCopy:
    """How a table is copied into a relational store: statements and writer options, all text.

    Rows go to a staging table of stated types. Each carries a number that is
    its primary key there, so that a task which is run again after its rows
    were committed fails on them and does not double them. When all rows are
    in, the staging table takes the target's place in one transaction; until
    then readers see the old target.
    """

    table: str
    staging: str
    prepare: tuple[str, ...]
    options: dict[str, str]
    count: str
    publish: tuple[str, ...]
    abandon: tuple[str, ...]


COPY_ROW = "_copy_row"


def relational_copy(schema: T.StructType, table: str, properties: dict[str, str] | None = None, connections: int = 16) -> RelationalCopy:
    """The statements that copy a table with this schema, types and NOT NULL as pinned."""

    def ident(of: str) -> str:
        return '"' + of.replace('"', '""') + '"'

    if COPY_ROW in schema.names:
        raise ValueError(f"{table}: a column may not be called {COPY_ROW}")
    *database, last = table.split(".")
    prefix = "".join(f"{ident(d)}." for d in database)
    staging = f"{prefix}{ident(f'{last}__staging')}"
    target = f"{prefix}{ident(last)}"
    columns = [f"{ident(f.name)} {typing.copy_type(f.dataType)}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields]
    return RelationalCopy(
        table=target,
        staging=staging,
        prepare=(
            f"DROP TABLE IF EXISTS {staging}",
            f"CREATE TABLE {staging} ({', '.join([*columns, f'{ident(COPY_ROW)} bigint PRIMARY KEY'])})",
        ),
        options=jdbc_options(properties, connections),
        count=f"SELECT count(*) FROM {staging}",
        publish=(
            f"ALTER TABLE {staging} DROP COLUMN {ident(COPY_ROW)}",
            f"DROP TABLE IF EXISTS {target}",
            f"ALTER TABLE {staging} RENAME TO {ident(last)}",
        ),
        abandon=(f"DROP TABLE IF EXISTS {staging}",),
    )


class Store(Protocol):
    """A relational store: what a copy asks of it."""

    def execute(self, statements: Sequence[str]) -> None:
        """Run the statements in one transaction; none of them holds if one fails."""

    def append(self, df: DataFrame, table: str, options: dict[str, str]) -> None:
        """Add rows to a table, written by the tasks."""

    def number(self, sql: str) -> int:
        """The one number a query returns."""


class JdbcStore:
    """A store behind a JDBC driver: statements run on the driver, rows are written by the executors."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None):
        self.spark, self.url, self.properties = spark, url, properties or {}

    def _connection(self):
        settings = self.spark._jvm.java.util.Properties()
        for k, v in self.properties.items():
            settings.setProperty(k, v)
        return self.spark._jvm.java.sql.DriverManager.getConnection(self.url, settings)

    def execute(self, statements: Sequence[str]) -> None:
        connection = self._connection()
        try:
            connection.setAutoCommit(False)
            for sql in statements:
                connection.createStatement().executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def append(self, df: DataFrame, table: str, options: dict[str, str]) -> None:
        df.write.mode("append").jdbc(self.url, table, properties=self.properties | options)

    def number(self, sql: str) -> int:
        connection = self._connection()
        try:
            found = connection.createStatement().executeQuery(sql)
            found.next()
            return found.getLong(1)
        finally:
            connection.close()


def copy_relational(df: DataFrame, store: Store, table: str, connections: int = 16) -> int:
    """Full-refresh copy into a relational store; the number of rows copied.

    A copy that fails at any step leaves the target as it was and no staging
    table, and can be run again.
    """
    steps = relational_copy(df.schema, table, connections=connections)
    store.execute(steps.prepare)
    try:
        store.append(df.withColumn(COPY_ROW, F.monotonically_increasing_id()), steps.staging, steps.options)
        copied, rows = store.number(steps.count), df.count()
        if copied != rows:
            raise RuntimeError(f"{table}: {copied} rows copied of {rows}")
        store.execute(steps.publish)
    except Exception:
        store.execute(steps.abandon)
        raise
    return copied


def copy_all(frames: dict[str, DataFrame], store: Store, parallel: int = 4) -> DataFrame:
    """Copy tables into a relational store, each on its own: the run log."""
    spark = next(iter(frames.values())).sparkSession

    def one(table: str) -> DataFrame:
        copy_relational(frames[table], store, table)
        return frames[table]

    return load_tables(spark, "relational", {t: lambda t=t: one(t) for t in frames}, parallel)


def publish_views(spark: SparkSession, source_db: str, view_db: str) -> DataFrame:
    """A pass-through view per table of a database: (view_name, n_columns)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(view_db)}")
    rows = []
    for t in sorted(spark.catalog.listTables(source_db), key=lambda t: t.name):
        if t.isTemporary:
            continue
        view = quoted(view_db, t.name)
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {quoted(source_db, t.name)}")
        rows.append((t.name, len(spark.catalog.listColumns(view))))
    return local_frame(spark, rows, "view_name string, n_columns int")


def drop_views(spark: SparkSession, view_db: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(view_db)} CASCADE")


def list_schemas(spark: SparkSession) -> DataFrame:
    rows = sorted({(d.name,) for d in spark.catalog.listDatabases()})
    return local_frame(spark, rows, "schema_name string")


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """(schema_name, table_name), of one schema or of all."""
    names = [schema] if schema else [d.name for d in spark.catalog.listDatabases()]
    rows = sorted((n, t.name) for n in names for t in spark.catalog.listTables(n) if not t.isTemporary)
    return local_frame(spark, rows, "schema_name string, table_name string")


def param_sql(spark: SparkSession, sql: str, params: list | None = None, limit: int | None = 1000) -> DataFrame:
    """Parametrised SQL with a row cap; no cap when ``limit`` is None or 0."""
    result = spark.sql(sql, args=params) if params else spark.sql(sql)
    return result.limit(limit) if limit else result


def write_report(df: DataFrame, path: str) -> tuple[str, str]:
    """One small result as CSV and as JSON."""
    csv_path, json_path = f"{path}/csv", f"{path}/json"
    df.write.option("header", True).csv(csv_path)
    df.write.json(json_path)
    return csv_path, json_path


def run_summary(log: DataFrame, run: str = "run_id") -> DataFrame:
    """Per loader: runs, tables per run, rows, average wall and table seconds.

    ``log`` holds (loader, run, table_name, rows, seconds) with one
    ``__total__`` row per run carrying its wall clock.
    """
    total = F.col("table_name") == "__total__"
    seconds = F.col("seconds").cast(T.DecimalType(18, 4))
    runs = F.count_if(total)
    wall = F.sum(F.when(total, seconds))
    tables = F.sum(F.when(~total, seconds))
    summary = log.groupBy("loader").agg(
        runs.alias("runs"),
        F.count_if(~total).alias("loads"),
        # The first run's total, as every run of a loader loads the same tables.
        F.min_by("rows", F.when(total, F.col(run))).alias("rows"),
        wall.alias("wall"),
        tables.alias("table_seconds"),
    )
    per_run = lambda c: (F.coalesce(F.col(c), F.lit(0)) / F.nullif(F.col("runs"), F.lit(0))).cast(T.DecimalType(18, 4))
    return summary.select(
        "loader",
        "runs",
        F.coalesce(F.floor(F.col("loads") / F.nullif(F.col("runs"), F.lit(0))), F.lit(0)).cast("bigint").alias("tables_per_run"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(per_run("wall"), F.lit(0)).cast(T.DecimalType(18, 4)).alias("avg_wall"),
        F.coalesce(per_run("table_seconds"), F.lit(0)).cast(T.DecimalType(18, 4)).alias("avg_table_seconds"),
    )
