"""Headline timings on the test tables; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
``load_all`` starts from text extracts, as the reference's load does; writing
those extracts is timed on its own. ``verify_all`` is the whole report over what
was loaded.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from lakeproof.plans import catalogue, queries_checks, staging, verify
from lakeproof.session import clear_scratch, local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = (
    "grouped_totals",
    "row_count",
    "passthrough_views",
    "scan_table",
    "column_profile",
    "token_census",
    "decimal_sums",
    "key_uniqueness",
    "fk_orphans",
    "fk_orphans_composite",
    "join_fanout",
    "star_join",
    "role_playing_join",
    "dangling_parents",
    "hierarchy_cycles",
    "reconcile_profiles",
    "diff_sample",
    "edge_diff",
    "check_value_digests",
    "check_aggregates_agree",
    "param_sql",
)


def main() -> None:
    # Files here are a few MB; small splits let every core take part.
    spark = local_session(CPUS, app="lakeproof-bench", **{"spark.sql.files.maxPartitionBytes": "8m"})
    seconds: dict[str, float] = {}

    def timed(name: str, run):
        start = time.perf_counter()
        result = run()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    timed("warm_up", lambda: spark.range(1000).groupBy("id").count().agg({"count": "sum"}).collect())
    timed("extract_all", lambda: staging.extract_all(spark, SF_DIR))
    timed("load_all", lambda: staging.prepare(spark, SF_DIR))
    dataset = queries_checks.dataset(spark, SF_DIR)
    report = timed(
        "verify_all", lambda: verify.report(verify.Verification(spark, dataset).assertions()).collect()
    )
    for name in QUERIES:
        timed(name, lambda: catalogue.QUERIES[name](spark, SF_DIR).collect())
    clear_scratch(spark)
    spark.stop()
    measured = {n: s for n, s in seconds.items() if n != "warm_up"}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(measured.values()), 3),
                "unit": "sec",
                "queries": measured,
                "checks_passed": sum(r.status == "PASS" for r in report),
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
