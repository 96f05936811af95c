"""Pinned table specs and the column catalog built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeproof.functions import casting, text, typing
from lakeproof.functions.sqltext import name as quoted
from lakeproof.session import local_frame


@dataclass(frozen=True)
class PinnedColumn:
    source_name: str
    name: str
    sql_type: str
    nullable: bool = True
    precision: int | None = None
    scale: int | None = None
    max_length: int | None = None

    @property
    def stored(self) -> T.DataType:
        return typing.spark_type(self.sql_type, self.precision, self.scale)


@dataclass(frozen=True)
class TableSpec:
    """One table's pinned schema.

    ``multi_line`` says that text may hold line breaks. It makes a file
    unsplittable, so it is off unless a table needs it.
    """

    source_table: str
    table: str
    columns: tuple[PinnedColumn, ...]
    multi_line: bool = False

    @property
    def kept(self) -> tuple[PinnedColumn, ...]:
        return tuple(c for c in self.columns if c.sql_type not in typing.EXCLUDED_TYPES)

    @property
    def text_schema(self) -> T.StructType:
        """Every column of the file as text, in file order."""
        return T.StructType([T.StructField(c.source_name, T.StringType()) for c in self.columns])

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.stored) for c in self.kept])


def projection(expressions: dict[str, str]) -> list[str]:
    """SQL select items from output name to expression."""
    return [f"{value} AS {quoted(name)}" for name, value in expressions.items()]


def label(spec: TableSpec, column: PinnedColumn) -> str:
    return f"{spec.table}.{column.name}"


def typed(spec: TableSpec, column: PinnedColumn, field: str) -> str:
    """A field's text, NULL where empty, to the stored value: NULs stripped, cast strictly."""
    if isinstance(column.stored, T.StringType):
        return text.strip_nul(field)
    return casting.strict_cast(field, column.stored, label(spec, column))


def tried(column: PinnedColumn, field: str) -> str:
    """``typed``, but a field that does not parse is NULL."""
    if isinstance(column.stored, T.StringType):
        return text.strip_nul(field)
    return casting.parsed(field, column.stored)


def guarded(spec: TableSpec, column: PinnedColumn, value: str) -> str:
    """Raise on NULL where the pinned schema says NOT NULL."""
    return value if column.nullable else casting.not_null(value, column.stored, label(spec, column))


CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("sql_type", T.StringType()),
        T.StructField("precision", T.IntegerType()),
        T.StructField("scale", T.IntegerType()),
        T.StructField("nullable", T.BooleanType()),
    ]
)


def column_catalog(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    """One row per pinned column, file order kept, excluded columns included."""
    rows = [
        (s.source_table, s.table, i, c.source_name, c.name, c.sql_type, c.precision, c.scale, c.nullable)
        for s in specs
        for i, c in enumerate(s.columns)
    ]
    return local_frame(spark, rows, CATALOG_SCHEMA)


_DOCUMENT = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField(
            "columns",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("source_name", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("sql_type", T.StringType()),
                        T.StructField("max_length", T.IntegerType()),
                        T.StructField("precision", T.IntegerType()),
                        T.StructField("scale", T.IntegerType()),
                        T.StructField("nullable", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The column catalog from a folder of schema documents, one JSON per table."""
    documents = spark.read.schema(_DOCUMENT).json(path, multiLine=True)
    return documents.select("source_table", "table", F.posexplode("columns").alias("ordinal", "c")).select(
        "source_table",
        F.col("table").alias("table_name"),
        "ordinal",
        "c.source_name",
        F.col("c.name").alias("column_name"),
        "c.sql_type",
        "c.precision",
        "c.scale",
        "c.nullable",
    )


def specs_from_catalog(catalog: DataFrame) -> list[TableSpec]:
    """Specs for the loader; metadata only, one row per column."""
    tables: dict[str, list] = {}
    for row in catalog.orderBy("table_name", "ordinal").collect():
        tables.setdefault(row.table_name, []).append(row)
    return [
        TableSpec(
            source_table=rows[0].source_table,
            table=name,
            columns=tuple(
                PinnedColumn(r.source_name, r.column_name, r.sql_type, r.nullable, r.precision, r.scale)
                for r in rows
            ),
        )
        for name, rows in tables.items()
    ]


def kept_columns(catalog: DataFrame) -> DataFrame:
    """The catalog without the column types that are never loaded."""
    return catalog.where(~F.col("sql_type").isin(*typing.EXCLUDED_TYPES))


def select_tables(available: DataFrame, wanted: list[str], excluded: tuple[str, ...] = ()) -> DataFrame:
    """The wanted tables (all when empty) with the ones nobody has marked missing.

    ``available`` has a ``table_name`` column; excluded tables are never offered.
    """
    offered = available.where(~F.col("table_name").isin(*excluded)) if excluded else available
    if not wanted:
        return offered.select("table_name", F.lit("selected").alias("status"))
    asked = local_frame(available.sparkSession, [(w,) for w in dict.fromkeys(wanted)], "table_name string")
    found = asked.join(offered, "table_name", "left_semi").select("table_name", F.lit("selected").alias("status"))
    missing = asked.join(offered, "table_name", "left_anti").select("table_name", F.lit("missing").alias("status"))
    return found.unionAll(missing)
