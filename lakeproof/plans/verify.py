"""The whole verification: extracts on one side, stored tables on the other.

Each extract is parsed once and each stored table scanned once for its profile.
Profiles, audits and assertions have a row per column, edge or check; they are
kept as local relations. Keys, edges and hierarchies read only the key columns.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.functions.sqltext import name
from lakeproof.operators import assertions, keys, profile
from lakeproof.operators import edges as rel
from lakeproof.operators.keys import Edge
from lakeproof.plans import checks
from lakeproof.session import local_frame, settle, settle_each
from lakeproof.sources import delimited, footers, specs
from lakeproof.sources.specs import TableSpec


@dataclass(frozen=True)
class Dataset:
    """What is verified: specs, extract and lake folders, and the relationships."""

    specs: Mapping[str, TableSpec]
    extracts: Mapping[str, str]
    stored: Mapping[str, str]
    known: Mapping[str, int]
    curated: Sequence[Edge]
    declared: Sequence[Edge] | None = None
    # Per reader: its tables, each a folder or what opens a table or view.
    copies: Mapping[str, Mapping[str, str | Callable[[], DataFrame]]] = field(default_factory=dict)


class Verification:
    """The shared measurements, made once and used by several checks."""

    def __init__(self, spark: SparkSession, of: Dataset):
        self.spark, self.of = spark, of
        self._made: dict[str, Any] = {}
        self.seconds: dict[str, float] = {}
        self._once = {name: Lock() for name in ("profiles", "audit", "classified")}
        # Tables that were never loaded have no frame; the checks that need one say so.
        self.frames = {t: self._read(t, of.stored[t]) for t in of.specs if t in of.stored}
        self.catalog = specs.kept_columns(specs.column_catalog(spark, list(of.specs.values())))

    def _read(self, table: str, path: str) -> DataFrame:
        """A stored table as it lies there, without the guard."""
        return self.spark.read.schema(self.of.specs[table].stored_schema).parquet(path)

    def _made_once(self, name: str, make: Callable[[], Any]) -> Any:
        """A measurement that several checks ask for at the same time: made by the first, read by the others."""
        with self._once[name]:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    def classify(self) -> DataFrame:
        """One row per key column: metadata, kept as a local relation."""
        return self._made_once("classified", lambda: settle(rel.classify_keys(self.catalog)))

    def measured(self) -> tuple[DataFrame, dict[tuple[str, str], str]]:
        """One parse of every extract and one scan of every stored table; what failed, by table and side, with the reason.

        A table that fails on one side is left out on the other as well: it
        has one finding, and the other tables are compared as ever.
        """

        def scan(table: str) -> DataFrame:
            if table not in self.frames:
                raise LookupError("has not been loaded")
            return profile.lake_profile(self.frames[table], table)

        def make() -> tuple[DataFrame, dict[tuple[str, str], str]]:
            source = {
                (t, "source"): lambda t=t, s=s: profile.source_profile(delimited.fields(self.spark, self.of.extracts[t], s), s)
                for t, s in self.of.specs.items()
            }
            stored = {(t, "lake"): lambda t=t: scan(t) for t in self.of.specs}
            rows, failed = settle_each(source | stored)
            if rows is None:
                rows = local_frame(self.spark, [], "side string, table_name string, column_name string, metric string, value decimal(38,4)")
            return rows.where(~F.col("table_name").isin(sorted({t for t, _ in failed}))), failed

        return self._made_once("profiles", make)

    @property
    def source(self) -> DataFrame:
        return self.measured()[0].where("side = 'source'")

    @property
    def lake(self) -> DataFrame:
        return self.measured()[0].where("side = 'lake'")

    def _both(self, table: str) -> tuple[DataFrame, DataFrame]:
        """A table as extracted, refused fields as NULL, and as stored."""
        spec = self.of.specs[table]
        fields = delimited.fields(self.spark, self.of.extracts[table], spec)
        extracted = fields.selectExpr(*specs.projection({c.name: specs.tried(c, name(c.name)) for c in spec.kept}))
        return extracted, self.frames[table]

    def notes(self, names: Sequence[str] = checks.NAMES) -> DataFrame:
        """(check_name, subject, note): what passing checks do not say, from measurements already made."""
        told: dict[str, Callable[[], DataFrame]] = {
            "type_mapping": lambda: checks.type_notes(self.spark, self.catalog),
            "referential_integrity": lambda: checks.audit_notes(self.audit()),
        }
        if self.of.declared is not None:
            told["foreign_key_oracle"] = lambda: checks.edge_notes(self.classify(), rel.edge_frame(self.spark, self.of.declared))
        rows = [(n, r.subject, r.note) for n in names if n in told for r in told[n]().orderBy("subject").collect()]
        return local_frame(self.spark, rows, "check_name string, subject string, note string")

    def timings(self) -> DataFrame:
        """(check_name, seconds) of the checks that have run; shared measurements count for the first that waits for them."""
        return local_frame(self.spark, sorted(self.seconds.items()), "check_name string, seconds double")

    def _unmeasured(self, check: str, found: DataFrame) -> DataFrame:
        """The check's assertions, and a failed one for each table and side without a profile."""
        failed = self.measured()[1]
        rows = [(f"{t} {side}", "measured", why, False) for (t, side), why in sorted(failed.items())]
        return found.unionAll(assertions.stated(self.spark, check, rows)) if rows else found

    def _unloaded(self, check: str, found: DataFrame | None, absent: dict[str, set[str]]) -> DataFrame:
        """The check's assertions, and a failed one for each subject whose tables were never loaded."""
        rows = [(subject, "loaded", f"not loaded: {', '.join(sorted(tables))}", False) for subject, tables in sorted(absent.items())]
        stated = assertions.stated(self.spark, check, rows)
        return stated if found is None else found.unionAll(stated) if rows else found

    @cached_property
    def stored(self) -> DataFrame:
        return settle(footers.stored_catalog(self.spark, {t: p for t, p in self.of.stored.items() if t in self.of.specs}))

    def edges(self) -> list[Edge]:
        sets = [rel.derived_edges(self.classify()), rel.edge_frame(self.spark, self.of.curated)]
        if self.of.declared is not None:
            sets.append(rel.edge_frame(self.spark, self.of.declared))
        return rel.edge_list(rel.edge_union(*sets))

    def audit(self) -> DataFrame:
        """One row per edge between loaded tables."""
        return self._made_once("audit", lambda: settle(keys.edge_audit(self.frames, self._split(self.edges())[0])))

    def _split(self, edges: Sequence[Edge]) -> tuple[list[Edge], dict[str, set[str]]]:
        """Edges between loaded tables; of the others, the tables that are missing."""
        missing = {keys.spell_edge(e): {e[0], e[2]} - set(self.frames) for e in edges}
        return [e for e in edges if not missing[keys.spell_edge(e)]], {e: m for e, m in missing.items() if m}

    def _primary_keys(self) -> DataFrame:
        named = [(r.table_name, (r.column_name,)) for r in rel.primary_keys(self.catalog).collect()]
        here = [n for n in named if n[0] in self.frames]
        absent = {f"{t}.{'+'.join(c)}": {t} for t, c in named if t not in self.frames}
        return self._unloaded("primary_keys", checks.primary_keys(self.frames, here) if here else None, absent)

    def _referential(self) -> DataFrame:
        here, absent = self._split(self.edges())
        found = checks.referential_integrity(self.audit(), self.classify(), self.frames, here)
        return self._unloaded("referential_integrity", found, absent)

    def _hierarchies(self) -> DataFrame:
        here, absent = self._split(rel.edge_list(rel.hierarchy_edges(self.classify())))
        return self._unloaded("hierarchies", checks.hierarchies(self.frames, here) if here or not absent else None, absent)

    def _copies(self) -> DataFrame:
        def reader(tables: Mapping[str, str | Callable[[], DataFrame]]):
            return lambda: profile.row_counts({t: at() if callable(at) else self._read(t, at) for t, at in tables.items()})

        expected = profile.row_counts(self.frames)
        return checks.copies_agree({name: reader(paths) for name, paths in self.of.copies.items()}, expected)

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        declared = None if self.of.declared is None else rel.edge_frame(self.spark, self.of.declared)
        curated = rel.edge_frame(self.spark, self.of.curated)
        return {
            "known_baseline": lambda: checks.known_baseline(self.lake, self.of.known),
            "row_counts": lambda: checks.row_counts(self.source, self.lake),
            "types": lambda: checks.types(self.catalog, self.stored),
            "type_mapping": lambda: checks.type_mapping(self.spark, self.catalog),
            "nullability_flags": lambda: checks.nullability_flags(self.catalog, self.stored, self.lake),
            "nullability_enforced": lambda: checks.guard_enforced(self.spark, self.frames, self.of.specs),
            "null_reconciliation": lambda: checks.null_reconciliation(self.source, self.lake, self.catalog),
            "source_values": lambda: checks.source_values(self.source, self.lake),
            "value_digests": lambda: checks.value_digests(self.source, self.lake, self._both),
            "primary_keys": self._primary_keys,
            "foreign_key_oracle": lambda: checks.foreign_key_oracle(
                self.catalog, self.classify(), declared, curated, self.of.known
            ),
            "referential_integrity": self._referential,
            "hierarchies": self._hierarchies,
            "decimal_exactness": lambda: checks.decimal_exactness(self.source, self.lake),
            "copies_agree": self._copies,
        }

    def assertions(self, names: Sequence[str] = checks.NAMES, parallel: int = 8) -> DataFrame:
        """The selected checks' assertions; an unknown name is an error.

        A check that cannot run is a failed check, not a crash.
        """
        unknown = sorted(set(names) - set(checks.NAMES))
        if unknown:
            raise ValueError(f"unknown check(s): {', '.join(unknown)}")
        builders = self._builders()

        def run(check: str) -> DataFrame:
            start = time.perf_counter()
            try:
                found = builders[check]()
                return settle(self._unmeasured(check, found) if check in _PROFILED else found)
            except Exception as exc:
                reason = f"{type(exc).__name__}: {str(exc).splitlines()[0]}"
                return assertions.stated(self.spark, check, [("the check itself", "runs", reason, False)])
            finally:
                self.seconds[check] = time.perf_counter() - start

        # Shared measurements first, side by side; the checks then only read them.
        self.classify()
        with ThreadPoolExecutor(parallel) as pool:
            if set(names) & _PROFILED:
                pool.submit(self.measured)
            if "referential_integrity" in names:
                pool.submit(self.audit)
            own = {n: pool.submit(run, n) for n in names if n not in _PROFILED and n != "referential_integrity"}
            own = {n: f.result() for n, f in own.items()}
        with ThreadPoolExecutor(parallel) as pool:
            rest = [n for n in names if n not in own]
            own |= dict(zip(rest, pool.map(run, rest)))
        return assertions.all_of([own[n] for n in names])


# Checks that read the profiles.
_PROFILED = {
    "known_baseline",
    "row_counts",
    "nullability_flags",
    "null_reconciliation",
    "source_values",
    "value_digests",
    "decimal_exactness",
}


def report(found: DataFrame, names: Sequence[str] = checks.NAMES) -> DataFrame:
    return assertions.summarise(found, names)


def exit_code(results: DataFrame, strict: bool = False) -> int:
    """1 if a check failed, or was skipped when nothing may be; else 0."""
    bad = ["FAIL", "SKIP"] if strict else ["FAIL"]
    return int(not results.where(results.status.isin(*bad)).isEmpty())


def known_gaps(spark: SparkSession) -> DataFrame:
    """What the checks do not see, stated with every report."""
    return local_frame(spark, [(g,) for g in checks.KNOWN_GAPS], "gap string")
