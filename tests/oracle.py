"""Compare a registered query with its SQL on the same parquet files.

Run as a script: python -m tests.oracle [sf_dir] [query …]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from lakeproof.plans import catalogue, star

_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def expected(sf_dir: str, sql: str) -> tuple[dict[str, str], Counter]:
    con = duckdb.connect()
    con.execute("SET threads = 1")
    for t in star.PHYSICAL:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(range(len(types)), key=lambda i: list(types)[i])
    rows = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    con.close()
    return types, rows


def actual(spark, sf_dir: str, name: str) -> tuple[dict[str, str], Counter]:
    df = catalogue.QUERIES[name](spark, sf_dir)
    types = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        types[f.name] = _TYPES.get(kind, kind.upper())
    order = sorted(df.columns)
    return types, Counter(tuple(r[c] for c in order) for r in df.collect())


def differences(spark, sf_dir: str, name: str) -> list[str]:
    """Empty when columns, types and rows agree."""
    got_types, got = actual(spark, sf_dir, name)
    if name not in catalogue.ORACLES:
        return []
    want_types, want = expected(sf_dir, catalogue.ORACLES[name])
    out = []
    if got_types != want_types:
        out.append(f"types {got_types} want {want_types}")
    if got != want:
        out.append(f"only in Spark {list((got - want).items())[:3]}, only in SQL {list((want - got).items())[:3]}")
    if not want:
        out.append("the oracle is empty")
    return out


if __name__ == "__main__":
    from lakeproof.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalogue.QUERIES)
    spark = local_session("8")
    bad = 0
    for n in names:
        start = time.perf_counter()
        try:
            found = differences(spark, sf, n)
        except Exception as exc:  # shown, then the next query
            found = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        took = time.perf_counter() - start
        bad += bool(found)
        kind = "" if n in catalogue.ORACLES else " (no oracle)"
        print(f"{'FAIL' if found else 'ok  '} {took:6.2f}s {n}{kind}", *[f"\n       {f}" for f in found], flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
