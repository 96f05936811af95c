"""A warehouse on files: schema documents, extracts, a lake database.

The folder layout is one ``<Table>.json`` schema document and one ``<Table>.csv``
extract per table, and optionally one document of declared foreign keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.functions import typing
from lakeproof.operators import edges as rel
from lakeproof.operators import profile
from lakeproof.operators.keys import Edge
from lakeproof.plans import checks, verify
from lakeproof.session import local_frame
from lakeproof.sources import constraints, delimited, lake, specs
from lakeproof.sources.specs import TableSpec


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        schemas: str,
        extracts: str,
        root: str,
        database: str = "raw",
        foreign_keys: str | None = None,
        curated: Sequence[Edge] = (),
        multi_line: Iterable[str] = (),
    ):
        self.spark, self.extracts, self.root, self.database = spark, extracts.rstrip("/"), root, database
        self.foreign_keys, self.curated = foreign_keys, curated
        wide = set(multi_line)
        found = specs.specs_from_catalog(specs.read_catalog(spark, schemas))
        self.specs: dict[str, TableSpec] = {
            s.table: TableSpec(s.source_table, s.table, s.columns, s.table in wide)
            for s in found
            if _stem(s) not in typing.EXCLUDED_TABLES
        }

    def extract_of(self, table: str) -> str:
        return f"{self.extracts}/{_stem(self.specs[table])}.csv"

    def select(self, wanted: Sequence[str] = ()) -> DataFrame:
        """(table_name, status): what would be loaded, and which names are unknown."""
        available = local_frame(self.spark, [(t,) for t in sorted(self.specs)], "table_name string")
        return specs.select_tables(available, list(wanted))

    def load(self, wanted: Sequence[str] = (), parallel: int = 4) -> DataFrame:
        """Full refresh of the wanted tables (all by default): the run log, unknown names as failures in it."""
        chosen = [r.table_name for r in self.select(wanted).orderBy("table_name").collect()]
        return lake.load_tables(self.spark, "lakeproof", {t: lambda t=t: self._load(t) for t in chosen}, parallel)

    def _load(self, table: str) -> DataFrame:
        if table not in self.specs:
            raise LookupError(f"no table named {table}")
        spec = self.specs[table]
        pinned = delimited.pinned_scan(self.spark, self.extract_of(table), spec)
        path = lake.full_refresh(pinned, self.database, table, self.root)
        return lake.scan(self.spark, path, spec)

    def table(self, table: str) -> DataFrame:
        """A loaded table under its pinned schema, NOT NULL included."""
        return lake.scan(self.spark, self._path(table), self.specs[table])

    def _path(self, table: str) -> str:
        path = lake.location(self.spark, self.database, table)
        if path is None:
            raise LookupError(f"{self.database}.{table} has not been loaded")
        return path

    def publish_views(self, view_db: str) -> DataFrame:
        return lake.publish_views(self.spark, self.database, view_db)

    def copy(self, database: str, root: str, wanted: Sequence[str] = (), parallel: int = 4) -> DataFrame:
        """Full-refresh copy of loaded tables into another database: the run log."""
        chosen = [r.table_name for r in self.select(wanted).where("status = 'selected'").orderBy("table_name").collect()]

        def one(table: str) -> DataFrame:
            path = lake.full_refresh(self.table(table), database, table, root)
            return lake.scan(self.spark, path, self.specs[table])

        return lake.load_tables(self.spark, "copy", {t: lambda t=t: one(t) for t in chosen}, parallel)

    def probe(self, table: str, key: str, amount: str, readers: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Grouped totals of a table, checked against other readers of it."""
        totals = profile.grouped_totals(self.table(table), key, amount)
        if not readers:
            return totals
        others = {n: profile.grouped_totals(df, key, amount) for n, df in readers.items()}
        return checks.aggregates_agree(totals, others, key)

    def dataset(self, known: Mapping[str, int], copies: Sequence[str] = ()) -> verify.Dataset:
        """What to verify; ``copies`` names databases that hold a copy or views."""
        declared = None
        if self.foreign_keys is not None:
            declared = rel.edge_list(constraints.read_constraints(self.spark, self.foreign_keys))
        return verify.Dataset(
            specs=self.specs,
            extracts={t: self.extract_of(t) for t in self.specs},
            stored={t: p for t in self.specs if (p := lake.location(self.spark, self.database, t)) is not None},
            known=known,
            curated=self.curated,
            declared=declared,
            copies={db: {t: partial(self.spark.table, lake.quoted(db, t)) for t in self.specs} for db in copies},
        )

    def verify(
        self, known: Mapping[str, int], names: Sequence[str] = checks.NAMES, copies: Sequence[str] = ()
    ) -> tuple[DataFrame, DataFrame]:
        """The report, one row per check, and the assertions behind it."""
        found = verify.Verification(self.spark, self.dataset(known, copies)).assertions(names)
        return verify.report(found, names).orderBy(F.col("position")), found


def _stem(spec: TableSpec) -> str:
    return spec.source_table.split(".")[-1]
