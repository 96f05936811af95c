"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

Key = TypeVar("Key", bound=Hashable)

# One place for the settings the jobs rely on. Skewed join sides are split by
# AQE; broadcasts stay under the size Catalyst can prove from statistics.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Columns pinned as time; off by default.
    "spark.sql.timeType.enabled": "true",
}


def local_session(cores: str = "*", app: str = "lakeproof", **extra: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="lakeproof-")
    return _LOCAL_ROOTS[app]


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that nothing has used before."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/lakeproof/{app}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application left in the scratch folder."""
    remove(spark, f"{scratch_root(spark)}/lakeproof/{spark.sparkContext.applicationId}")


def write_scratch(df: DataFrame, label: str) -> str:
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage and survives the loss of an executor; unlike an RDD
    checkpoint the frame is computed once and stays columnar.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, label))


def settle(df: DataFrame) -> DataFrame:
    """Run a job now and keep its rows as a local relation.

    Only for results with one row per column, key, edge or check, whose number
    the schema bounds and the data does not.
    """
    return _local(df.sparkSession, [df.toArrow()], df.schema)


def _local(spark: SparkSession, tables: Sequence[pa.Table], schema: T.StructType) -> DataFrame:
    # One chunk: rows behind two empty chunks are lost when a frame is made.
    return spark.createDataFrame(pa.concat_tables(tables).combine_chunks(), schema)


def settle_all(builders: Sequence[Callable[[], DataFrame]], parallel: int = 8) -> DataFrame:
    """Plan and run independent small jobs side by side; their rows as one local relation.

    Planning and compiling one does not wait for another, and idle executors
    take the tasks of whichever is ready.
    """

    def run(build: Callable[[], DataFrame]) -> tuple[DataFrame, pa.Table]:
        df = build()
        return df, df.toArrow()

    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(run, builders))
    first = done[0][0]
    return _local(first.sparkSession, [rows for _, rows in done], first.schema)


def settle_each(builders: Mapping[Key, Callable[[], DataFrame]], parallel: int = 8) -> tuple[DataFrame | None, dict[Key, str]]:
    """``settle_all``, each job on its own: the rows of those that ran, and why the others did not."""

    def run(build: Callable[[], DataFrame]) -> tuple[DataFrame, pa.Table] | str:
        try:
            df = build()
            return df, df.toArrow()
        except Exception as exc:  # told with the report, by whoever asked
            return f"{type(exc).__name__}: {str(exc).splitlines()[0]}"

    with ThreadPoolExecutor(parallel) as pool:
        done = dict(zip(builders, pool.map(run, builders.values()), strict=True))
    ran = [r for r in done.values() if not isinstance(r, str)]
    rows = _local(ran[0][0].sparkSession, [t for _, t in ran], ran[0][0].schema) if ran else None
    return rows, {k: r for k, r in done.items() if isinstance(r, str)}


def local_frame(spark: SparkSession, rows: list[tuple], ddl: str | T.StructType) -> DataFrame:
    """Metadata rows as a local relation, whose small size the planner can see."""
    schema = T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
