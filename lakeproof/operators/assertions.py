"""Checks as rows.

A check is a frame of assertions ``(check_name, subject, expected, actual, ok)``,
one row per table, column or edge it looked at. Results and findings are
aggregations of those rows, so any number of checks is one union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeproof.operators.profile import union_all
from lakeproof.operators.reconcile import first_per_group
from lakeproof.session import local_frame

ASSERTION = ["check_name", "subject", "expected", "actual", "ok"]
ASSERTION_SCHEMA = "check_name string, subject string, expected string, actual string, ok boolean"
FINDINGS_PER_CHECK = 10


def plain(value: Column) -> Column:
    """A decimal measurement without meaningless zeros: 12, 12.5."""
    return F.regexp_replace(value.cast("string"), r"\.?0+$", "")


def assertions(df: DataFrame, check: str, subject: Column, expected: Column, actual: Column, ok: Column | None = None) -> DataFrame:
    """One assertion per row of ``df``; by default expected must equal actual."""
    e, a = expected.cast("string"), actual.cast("string")
    return df.select(
        F.lit(check).alias("check_name"),
        subject.cast("string").alias("subject"),
        e.alias("expected"),
        a.alias("actual"),
        F.coalesce(e.eqNullSafe(a) if ok is None else ok, F.lit(False)).alias("ok"),
    )


def stated(spark: SparkSession, check: str, rows: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """Assertions whose outcome the driver already knows."""
    return local_frame(spark, [(check, *r) for r in rows], ASSERTION_SCHEMA)


def summarise(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """(position, check_name, status, checked, failed, detail), in registry order.

    A check that looked at nothing is a SKIP, not a PASS.
    """
    per_check = found.groupBy("check_name").agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(~F.col("ok")).alias("failed")
    )
    order = local_frame(found.sparkSession, [(i, n) for i, n in enumerate(names, 1)], "position int, check_name string")
    checked = F.coalesce("checked", F.lit(0)).cast("bigint")
    failed = F.coalesce("failed", F.lit(0)).cast("bigint")
    status = F.when(checked == 0, "SKIP").when(failed > 0, "FAIL").otherwise("PASS")
    detail = (
        F.when(checked == 0, "nothing to check")
        .when(failed > 0, F.concat(failed.cast("string"), F.lit(" of "), checked.cast("string"), F.lit(" failed")))
        .otherwise(F.concat(F.lit("all "), checked.cast("string"), F.lit(" hold")))
    )
    return order.join(per_check, "check_name", "left").select(
        "position", "check_name", status.alias("status"), checked.alias("checked"), failed.alias("failed"), detail.alias("detail")
    )


def findings(found: DataFrame, n: int = FINDINGS_PER_CHECK) -> DataFrame:
    """The first n failed assertions of each check, by subject."""
    return first_per_group(found.where(~F.col("ok")), ["check_name"], ["subject", "expected", "actual"], n)


def all_of(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(f.select(*ASSERTION) for f in frames)
