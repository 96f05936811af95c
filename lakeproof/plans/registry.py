"""Named queries over the test tables, each with its oracle where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeproof.plans.star import STAR_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def over(*tables: str, body: str, also: dict[str, str] | None = None) -> str:
    """SQL over star tables; ``also`` adds relations derived from them."""
    relations = {t: STAR_SQL[t] for t in tables} | (also or {})
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in relations.items()) + "\n" + body


def rows_sql(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def values_sql(columns: str, rows: list[tuple]) -> str:
    """A literal relation."""

    def spell(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    listed = ", ".join("(" + ", ".join(spell(v) for v in r) + ")" for r in rows)
    return f"(VALUES {listed}) AS v({columns})"
