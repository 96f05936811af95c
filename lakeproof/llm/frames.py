"""Small helpers for document frames that all operators share."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeproof.session import materialise, new_scratch, remove, write_scratch

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

__all__ = ["documents", "materialise", "new_scratch", "plus", "read", "remove", "row_key", "same", "settled", "step", "sweep", "write_scratch"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; whatever else the frame has cannot clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def row_key(*columns: Column) -> Column:
    """Names a row where ids may be null or repeat; equal rows get equal keys."""
    return F.xxhash64(*columns)


def plus(schema: T.StructType, ddl: str) -> T.StructType:
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def step(df: DataFrame, label: str) -> DataFrame:
    """``materialise``, then let Spark's cleaner take the shuffle files of the finished job.

    They would stay until the driver happens to collect its garbage.
    """
    out = materialise(df, label)
    sweep(df.sparkSession)
    return out


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner take the shuffle files of finished jobs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once and read back, and its folder; the job's shuffle files are gone when it ends, not when Spark's cleaner comes by."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        path = write_scratch(df, label)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def same(*pairs: tuple[str, str]) -> Column:
    """A join condition in which null equals null."""
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out
