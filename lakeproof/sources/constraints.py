"""Foreign keys as the source declares them, with ordered column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeproof.functions import text, typing

_DOCUMENT = T.StructType(
    [
        T.StructField(
            "foreign_keys",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("constraint", T.StringType()),
                        T.StructField("from_table", T.StringType()),
                        T.StructField("from_columns", T.ArrayType(T.StringType())),
                        T.StructField("to_table", T.StringType()),
                        T.StructField("to_columns", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        )
    ]
)


def read_constraints(spark: SparkSession, path: str) -> DataFrame:
    """The declared constraints from their JSON document."""
    document = spark.read.schema(_DOCUMENT).json(path, multiLine=True)
    return document.select(F.inline("foreign_keys")).withColumnRenamed("constraint", "constraint_name")


def assemble_constraints(
    constraints: DataFrame, constraint_columns: DataFrame, tables: DataFrame, schemas: DataFrame, columns: DataFrame
) -> DataFrame:
    """Join the five system relations into one row per constraint.

    ``constraints(constraint_id, constraint_name, child_id, parent_id)``,
    ``constraint_columns(constraint_id, ordinal, child_column_id, parent_column_id)``,
    ``tables(table_id, schema_id, table_name)``, ``schemas(schema_id, schema_name)``,
    ``columns(table_id, column_id, column_name)``. A composite key stays one
    constraint; its columns come in constraint order whatever the row order is.
    Constraints that touch an excluded table are dropped.
    """
    placed = tables.join(schemas, "schema_id")

    def side(role: str) -> tuple[DataFrame, DataFrame]:
        named = placed.select(
            F.col("table_id").alias(f"{role}_id"),
            F.concat_ws(".", "schema_name", "table_name").alias(f"source_{role}"),
            F.col("table_name").alias(f"{role}_table"),
        )
        fields = columns.select(
            F.col("table_id").alias(f"{role}_id"),
            F.col("column_id").alias(f"{role}_column_id"),
            F.col("column_name").alias(f"{role}_column"),
        )
        return named, fields

    (child, child_fields), (parent, parent_fields) = side("child"), side("parent")
    rows = (
        constraints.join(constraint_columns, "constraint_id")
        .join(child, "child_id")
        .join(child_fields, ["child_id", "child_column_id"])
        .join(parent, "parent_id")
        .join(parent_fields, ["parent_id", "parent_column_id"])
        .where(~F.col("child_table").isin(*typing.EXCLUDED_TABLES))
        .where(~F.col("parent_table").isin(*typing.EXCLUDED_TABLES))
    )
    pairs = F.array_sort(F.collect_list(F.struct("ordinal", "child_column", "parent_column")))
    grouped = rows.groupBy("constraint_name", "source_child", "child_table", "source_parent", "parent_table").agg(
        pairs.alias("pairs")
    )
    return grouped.select(
        "constraint_name",
        F.col("source_child").alias("source_from_table"),
        text.snake_case(F.col("child_table")).alias("from_table"),
        F.transform("pairs", lambda p: text.snake_case(p.child_column)).alias("from_columns"),
        F.col("source_parent").alias("source_to_table"),
        text.snake_case(F.col("parent_table")).alias("to_table"),
        F.transform("pairs", lambda p: text.snake_case(p.parent_column)).alias("to_columns"),
    )


def column_loss(
    assembled: DataFrame, constraints: DataFrame, constraint_columns: DataFrame, tables: DataFrame
) -> DataFrame:
    """(declared, kept): constraint columns the source declares and the ones kept.

    A row lost in the joins would turn a composite key into a smaller one, so
    the two counts must agree.
    """
    wanted = tables.where(~F.col("table_name").isin(*typing.EXCLUDED_TABLES)).select("table_id")
    declared = (
        constraints.join(wanted.withColumnRenamed("table_id", "child_id"), "child_id", "left_semi")
        .join(wanted.withColumnRenamed("table_id", "parent_id"), "parent_id", "left_semi")
        .join(constraint_columns, "constraint_id")
        .agg(F.count("*").alias("declared"))
    )
    kept = assembled.agg(F.coalesce(F.sum(F.size("from_columns")), F.lit(0)).alias("kept"))
    both = declared.unionByName(kept, allowMissingColumns=True)
    return both.agg(F.max("declared").alias("declared"), F.max("kept").alias("kept"))
