"""How a pinned source type is stored: two independent statements.

``spark_type`` drives the loader. ``expected_type`` restates the same mapping
as a column expression over the column catalog and is what the type check
compares the lake with. They must not share a table, or the check would compare
the implementation with itself.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Column types that are never loaded, tables that are never loaded.
EXCLUDED_TYPES = ("varbinary", "binary", "image")
EXCLUDED_TABLES = ("DatabaseLog",)

# Stored type per pinned type. 8- and 16-bit integers widen.
_STORED = {
    "bit": T.BooleanType(),
    "tinyint": T.IntegerType(),
    "smallint": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "real": T.FloatType(),
    "float": T.DoubleType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "time": T.TimeType(6),
}
_PARAMETRIC = ("decimal", "numeric")


def spark_type(sql_type: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """The Spark type a pinned column is loaded as; unknown types are text."""
    if sql_type in _PARAMETRIC:
        return T.DecimalType(precision or 38, scale or 0)
    return _STORED.get(sql_type, T.StringType())


def expected_type(sql_type: Column, precision: Column, scale: Column) -> Column:
    """The type string the lake should report for a pinned column."""
    exact = F.concat(
        F.lit("decimal("),
        F.coalesce(F.nullif(precision, F.lit(0)), F.lit(38)).cast("string"),
        F.lit(","),
        F.coalesce(scale, F.lit(0)).cast("string"),
        F.lit(")"),
    )
    return (
        F.when(sql_type == "bit", "boolean")
        .when(sql_type.isin("tinyint", "smallint", "int"), "int")
        .when(sql_type == "bigint", "bigint")
        .when(sql_type == "real", "float")
        .when(sql_type == "float", "double")
        .when(sql_type.isin("decimal", "numeric"), exact)
        .when(sql_type == "money", "decimal(19,4)")
        .when(sql_type == "smallmoney", "decimal(10,4)")
        .when(sql_type == "date", "date")
        .when(sql_type.isin("datetime", "datetime2", "smalldatetime"), "timestamp_ntz")
        .when(sql_type == "datetimeoffset", "timestamp")
        .when(sql_type == "time", "time(6)")
        .otherwise("string")
    )


# Fixed values: (pinned type, precision, scale, stored type), every branch once.
GOLDEN_TYPES = (
    ("bit", None, None, "boolean"),
    ("tinyint", 3, 0, "int"),
    ("smallint", 5, 0, "int"),
    ("int", 10, 0, "int"),
    ("bigint", 19, 0, "bigint"),
    ("real", 24, None, "float"),
    ("float", 53, None, "double"),
    ("decimal", 18, 4, "decimal(18,4)"),
    ("numeric", 9, 2, "decimal(9,2)"),
    ("decimal", None, None, "decimal(38,0)"),
    ("money", 19, 4, "decimal(19,4)"),
    ("smallmoney", 10, 4, "decimal(10,4)"),
    ("date", None, None, "date"),
    ("datetime", None, None, "timestamp_ntz"),
    ("datetime2", None, None, "timestamp_ntz"),
    ("smalldatetime", None, None, "timestamp_ntz"),
    ("datetimeoffset", None, None, "timestamp"),
    ("time", None, None, "time(6)"),
    ("nvarchar", None, None, "string"),
    ("nchar", None, None, "string"),
    ("varchar", None, None, "string"),
    ("char", None, None, "string"),
    ("xml", None, None, "string"),
)

# Column type in a relational copy, by stored type.
_COPY = {
    "boolean": "boolean",
    "int": "integer",
    "bigint": "bigint",
    "float": "real",
    "double": "double precision",
    "date": "date",
    "timestamp_ntz": "timestamp",
    "timestamp": "timestamptz",
    "binary": "bytea",
}


def copy_type(stored: T.DataType) -> str:
    """The column type used when a lake table is copied to a relational store."""
    if isinstance(stored, T.DecimalType):
        return f"numeric({stored.precision},{stored.scale})"
    if isinstance(stored, T.TimeType):
        return "time"
    return _COPY.get(stored.simpleString(), "text")
