"""Types and NOT NULL flags as they stand in the footers of every file of a lake table."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeproof.operators.profile import union_all
from lakeproof.session import local_frame

_ROWS = "table_name string, file string, column_name string, stored_type string, required boolean"
_ARROW = pa.schema([("table_name", pa.string()), ("file", pa.string()), ("column_name", pa.string()), ("stored_type", pa.string()), ("required", pa.bool_())])
_KEY = b"org.apache.spark.sql.parquet.row.metadata"


def _uri(path: str) -> str:
    """A path as Spark spells it to one that names its file system for Arrow."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    return re.sub(r"^file:/(?!/)", "file:///", path)


def _fields(path: str) -> list[T.StructField]:
    """What the writer stored, from the end of the file alone."""
    store, name = pyarrow.fs.FileSystem.from_uri(_uri(path))
    with store.open_input_file(name) as file:
        kept = pyarrow.parquet.read_metadata(file).metadata or {}
    if _KEY not in kept:
        raise ValueError(f"{path} was not written by Spark")
    return T.StructType.fromJson(json.loads(kept[_KEY])).fields


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            {"table_name": table, "file": path, "column_name": f.name, "stored_type": f.dataType.simpleString(), "required": not f.nullable}
            for table, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for f in _fields(path)
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, path) of every data file; contents are not read."""
    listed = [
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(F.lit(table).alias("table_name"), "path")
        for table, path in paths.items()
    ]
    return union_all(listed)


def stored_footers(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, file, column_name, stored_type, required): one row for each column of each file.

    Reading a file table makes every field nullable and takes its types from
    one file or from the catalog; here the tasks of a job read the footers
    themselves. The store must be one that Arrow opens as well: a file system,
    hdfs, viewfs, s3 or gs.
    """
    return _files(spark, paths).mapInArrow(_read, _ROWS)


def stored_catalog(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, column_name, stored_type, required) of whole tables.

    Files that disagree show all their types, with a column that some files
    lack among them; a column is required if it is in every file.
    """
    if not paths:
        return local_frame(spark, [], "table_name string, column_name string, stored_type string, required boolean")
    every = stored_footers(spark, paths)
    files = _files(spark, paths).groupBy(F.col("table_name").alias("_table")).agg(F.count(F.lit(1)).alias("files"))
    found = every.groupBy("table_name", "column_name").agg(
        F.concat_ws(" or ", F.array_sort(F.collect_set("stored_type"))).alias("types"),  # as many as there are types
        F.bool_and("required").alias("all_required"),
        F.count_distinct("file").alias("present"),
    )
    joined = found.join(files, F.col("table_name") == F.col("_table"))
    whole = F.col("present") == F.col("files")
    stored = F.when(whole, F.col("types")).otherwise(F.concat("types", F.lit(" or absent")))
    return joined.select("table_name", "column_name", stored.alias("stored_type"), (F.col("all_required") & whole).alias("required"))
