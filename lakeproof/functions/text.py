"""Text rules: identifiers, NUL bytes, empties, comparable values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUL = "\x00"

# Literals a loader is liable to mistake for NULL.
WATCHED_TOKENS = ("NA", "N/A", "null", "NULL", "NaN", "nan", "n/a", "#N/A")

# The two boundaries between words of a PascalCase identifier.
_ACRONYM_END = "(.)([A-Z][a-z]+)"
_WORD_END = "([a-z0-9])([A-Z])"


def snake_case(name: Column) -> Column:
    """CustomerPONumber -> customer_po_number."""
    spaced = F.regexp_replace(name, _ACRONYM_END, "$1_$2")
    return F.lower(F.regexp_replace(spaced, _WORD_END, "$1_$2"))


def strip_nul(value: str) -> str:
    """Remove NUL bytes; a NUL-only value becomes '', NULL stays NULL."""
    return f"replace({value}, char(0), '')"


def empty_to_null(value: str) -> str:
    """Only the empty string means NULL; 'NA', 'null' and the like are values."""
    return f"nullif({value}, '')"


def comparable(value: Column) -> Column:
    """Numbers in any spelling to two decimals; other text unchanged."""
    two_places = F.round(value.try_cast(T.DecimalType(38, 4)), 2).cast(T.DecimalType(38, 2))
    return F.coalesce(two_places.cast("string"), value)


def stringified(df: DataFrame) -> DataFrame:
    """Everything a JSON number, text or boolean cannot carry becomes text."""
    plain = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType)
    return df.select(
        *[
            F.col(f.name) if isinstance(f.dataType, plain) else F.col(f.name).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )
