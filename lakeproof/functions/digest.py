"""Order-independent column digests, as SQL expressions.

A digest is the exact sum of one 64-bit (or 60-bit) hash per non-NULL value.
The hash is cut into three parts of at most 22 bits that are summed as bigints,
so the per-row work stays in generated code; a bigint holds 2^41 such parts.
The three sums are put together as one decimal at the end.
"""

from __future__ import annotations

from pyspark.sql import types as T

_PART_BITS = 22
_PART_MASK = (1 << _PART_BITS) - 1


def value_hash(value: str, of: T.DataType, portable: bool = False) -> str:
    """Hash of one value, NULL for NULL.

    ``portable`` uses md5 of the text form, which other engines can reproduce;
    the default hashes the typed value and is much cheaper.
    """
    if portable:
        return f"CAST(conv(substring(md5(CAST({value} AS STRING)), 1, 15), 16, 10) AS BIGINT)"
    # Negative zero and zero are equal values, so they must hash alike.
    hashed = f"{value} + 0F" if isinstance(of, T.FloatType) else f"{value} + 0D" if isinstance(of, T.DoubleType) else value
    return f"if({value} IS NULL, NULL, xxhash64({hashed}))"


def digest_parts(hashed: str) -> tuple[str, str, str]:
    """Aggregates: the sums of the low, middle and high bits of a hash column."""
    low, middle, high = (
        f"sum(shiftrightunsigned({hashed}, {n * _PART_BITS}) & {_PART_MASK}L)" for n in range(3)
    )
    return low, middle, high


def digest(low: str, middle: str, high: str) -> str:
    """One exact number from the three sums; 0 for no values."""
    weighted = (
        f"CAST(coalesce({part}, 0) AS DECIMAL(20,0)) * CAST({1 << (n * _PART_BITS)} AS DECIMAL(14,0))"
        for n, part in enumerate((low, middle, high))
    )
    return f"CAST({' + '.join(weighted)} AS DECIMAL(38,0))"
