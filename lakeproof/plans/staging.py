"""Extracts and lake tables made from the star, once per session and folder.

Queries about text files and stored tables need such files. They are written to
the shared scratch folder the first time a query asks and reused after that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from lakeproof.plans import star
from lakeproof.session import exists, new_scratch, remove
from lakeproof.sources import delimited, lake

_MADE: dict[tuple[str, str, str, str], str] = {}
_LOCK = Lock()


def _made(kind: str, spark: SparkSession, sf_dir: str, table: str) -> str | None:
    with _LOCK:
        known = _MADE.get((spark.sparkContext.applicationId, sf_dir, kind, table))
    return known if known and exists(spark, known) else None


def _once(kind: str, spark: SparkSession, sf_dir: str, table: str, make) -> str:
    known = _made(kind, spark, sf_dir, table)
    if known is None:
        known = make(new_scratch(spark, f"{kind}-{table}"))
        with _LOCK:
            _MADE[(spark.sparkContext.applicationId, sf_dir, kind, table)] = known
    return known


def _written(spark: SparkSession, sf_dir: str, table: str, path: str) -> str:
    return delimited.write_extract(star.frame(spark, sf_dir, table), path, star.SPECS[table])


def extract(spark: SparkSession, sf_dir: str, table: str) -> str:
    """The table as an extract: delimited text under source names."""
    return _once("extract", spark, sf_dir, table, lambda path: _written(spark, sf_dir, table, path))


def extract_all(spark: SparkSession, sf_dir: str, tables: Iterable[str] = star.TABLES, parallel: int = 4) -> list[str]:
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(lambda t: extract(spark, sf_dir, t), tables))


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The extract's fields as text, empties as ''."""
    return delimited.text_columns(spark, extract(spark, sf_dir, table), star.SPECS[table])


def load_into(spark: SparkSession, sf_dir: str, table: str, path: str) -> str:
    """Load one extract under its pinned schema."""
    return _loaded(spark, extract(spark, sf_dir, table), table, path)


def _loaded(spark: SparkSession, source: str, table: str, path: str) -> str:
    delimited.pinned_scan(spark, source, star.SPECS[table]).write.mode("overwrite").parquet(path)
    return path


def stored(spark: SparkSession, sf_dir: str, table: str) -> str:
    """The folder of the table as loaded from its extract."""
    return _once("lake", spark, sf_dir, table, lambda path: load_into(spark, sf_dir, table, path))


def stored_all(spark: SparkSession, sf_dir: str, tables: Iterable[str] = star.TABLES, parallel: int = 4) -> dict[str, str]:
    """The folders of several tables; what is missing is loaded side by side."""
    names = list(tables)
    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(names, pool.map(lambda t: stored(spark, sf_dir, t), names)))


def copied_all(spark: SparkSession, sf_dir: str, tables: Iterable[str] = star.TABLES, parallel: int = 4) -> dict[str, str]:
    """The folders of a second copy of the stored tables, written from them."""

    def copied(table: str) -> str:
        def make(path: str) -> str:
            scan(spark, sf_dir, table).write.parquet(path)
            return path

        return _once("copy", spark, sf_dir, table, make)

    names = list(tables)
    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(names, pool.map(copied, names)))


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return lake.scan(spark, stored(spark, sf_dir, table), star.SPECS[table])


@contextmanager
def passing(spark: SparkSession, sf_dir: str, table: str) -> Iterator[DataFrame]:
    """``scan`` for a use that ends with the block; only what was staged before is still there afterwards.

    A table that is to be written elsewhere needs its extract until it is
    loaded, and the loaded folder until it is written: text takes several times
    the table's own size, so that keeping all of it fills the disk.
    """
    path = _made("lake", spark, sf_dir, table)
    mine = []
    try:
        if path is None:
            source = _made("extract", spark, sf_dir, table)
            if source is None:
                mine.append(new_scratch(spark, f"passing-extract-{table}"))
                source = _written(spark, sf_dir, table, mine[0])
            mine.append(new_scratch(spark, f"passing-lake-{table}"))
            path = _loaded(spark, source, table, mine[-1])
            while len(mine) > 1:
                remove(spark, mine.pop(0))
        yield lake.scan(spark, path, star.SPECS[table])
    finally:
        for folder in mine:
            remove(spark, folder)


def prepare(spark: SparkSession, sf_dir: str, tables: Iterable[str] = star.TABLES, parallel: int = 4) -> DataFrame:
    """Extract and load the tables, several at a time; returns the run log."""
    loads = {
        t: lambda t=t: spark.read.schema(star.SPECS[t].stored_schema).parquet(stored(spark, sf_dir, t)) for t in tables
    }
    return lake.load_tables(spark, "lakeproof", loads, parallel)
