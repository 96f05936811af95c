"""The report on clean and broken datasets."""

from __future__ import annotations

import dataclasses
import os

import pytest

from lakeproof import session
from lakeproof.operators import assertions, profile
from lakeproof.plans import checks, planted, queries_checks, queries_ingest, staging, star, verify
from lakeproof.session import local_frame, new_scratch


@pytest.fixture(scope="module")
def dataset(spark, sf_dir):
    return queries_checks.dataset(spark, sf_dir)


def statuses(report):
    return {r.check_name: r.status for r in report.collect()}


def broken(spark, dataset, table, change):
    """The dataset with one stored table rewritten."""
    df = spark.read.schema(star.SPECS[table].stored_schema).parquet(dataset.stored[table])
    path = new_scratch(spark, "broken")
    change(df).write.parquet(path)
    return dataclasses.replace(dataset, stored={**dataset.stored, table: path})


def failing(spark, dataset, names):
    report = verify.report(verify.Verification(spark, dataset).assertions(names), names)
    return {n for n, s in statuses(report).items() if s == "FAIL"}


DATA_CHECKS = [n for n in checks.NAMES if n not in ("type_mapping", "nullability_enforced", "foreign_key_oracle", "copies_agree")]


@pytest.mark.parametrize(
    "table,change,caught",
    [
        ("dim_order", lambda df: df.where("order_status <> 'P'"),
         {"known_baseline", "row_counts", "value_digests", "decimal_exactness", "referential_integrity"}),
        ("dim_part", lambda df: planted.plant(df, {"part_name": "'x'"}), {"value_digests"}),
        ("dim_part", lambda df: planted.plant(df, {"part_size": "0"}), {"value_digests"}),
        ("dim_date", lambda df: planted.plant(df, {"full_date_alternate_key": "full_date_alternate_key + INTERVAL 1 DAY"}),
         {"value_digests"}),
        ("dim_customer", lambda df: planted.plant(df, {"market_segment": "nullif(market_segment, 'BUILDING')"}),
         {"value_digests", "null_reconciliation"}),
        ("dim_supplier", lambda df: df.unionAll(df.limit(1)),
         {"known_baseline", "row_counts", "value_digests", "primary_keys", "referential_integrity", "decimal_exactness"}),
        ("dim_order", lambda df: planted.plant(df, planted.STRAY_CUSTOMERS),
         {"value_digests", "referential_integrity", "nullability_flags"}),
        ("dim_customer", lambda df: planted.plant(df, planted.CYCLES), {"value_digests", "hierarchies", "nullability_flags"}),
        ("dim_customer", lambda df: planted.plant(df, planted.DANGLING),
         {"value_digests", "hierarchies", "referential_integrity", "nullability_flags"}),
    ],
)
def test_planted_defects_are_caught(spark, dataset, table, change, caught):
    found = failing(spark, broken(spark, dataset, table, change), DATA_CHECKS)
    # A table rewritten through a frame loses its NOT NULL flags.
    assert found - {"nullability_flags"} == caught - {"nullability_flags"}
    assert caught <= found


def test_a_swap_within_a_column_is_a_known_gap(spark, dataset):
    swapped = "CASE nation_key WHEN 1 THEN 'NATION_2' WHEN 2 THEN 'NATION_1' ELSE nation_name END"
    found = failing(
        spark, broken(spark, dataset, "dim_nation", lambda df: planted.plant(df, {"nation_name": swapped})), DATA_CHECKS
    )
    assert found <= {"nullability_flags"}
    assert any("swap" in r.gap for r in verify.known_gaps(spark).collect())


def test_unknown_check_is_refused(spark, dataset):
    with pytest.raises(ValueError, match="no_such_check"):
        verify.Verification(spark, dataset).assertions(["row_counts", "no_such_check"])


def test_a_broken_check_fails_and_the_rest_go_on(spark, dataset):
    gone = dataclasses.replace(dataset, copies={"gone": {"dim_region": "/nowhere/at/all"}}, known={})
    report = statuses(
        verify.report(
            verify.Verification(spark, gone).assertions(["known_baseline", "type_mapping", "copies_agree"]),
            ["known_baseline", "type_mapping", "copies_agree"],
        )
    )
    assert report == {"known_baseline": "FAIL", "type_mapping": "PASS", "copies_agree": "FAIL"}


def test_without_copies_the_check_is_skipped(spark, dataset):
    alone = dataclasses.replace(dataset, copies={})
    report = verify.report(verify.Verification(spark, alone).assertions(["copies_agree"]), ["copies_agree"])
    assert statuses(report) == {"copies_agree": "SKIP"}
    assert verify.exit_code(report) == 0 and verify.exit_code(report, strict=True) == 1


def test_without_declarations_minimality_is_still_tested(spark, dataset):
    listed = (*star.CURATED, star.DECLARED[0])
    undeclared = dataclasses.replace(dataset, declared=None, curated=listed)
    assert failing(spark, undeclared, ["foreign_key_oracle"]) == {"foreign_key_oracle"}


def test_vacuous_edges_are_named(spark):
    audit = local_frame(spark, [("a", 0), ("b", 3)], "edge string, compared bigint")
    assert [r.edge for r in checks.vacuous_edges(audit).collect()] == ["a"]


def test_findings_are_capped_per_check(spark):
    rows = [("c", f"s{i:02}", "1", "2", False) for i in range(30)] + [("d", "only", "1", "2", False), ("d", "fine", "1", "1", True)]
    found = local_frame(spark, rows, assertions.ASSERTION_SCHEMA)
    got = [(r.check_name, r.subject) for r in assertions.findings(found).orderBy("check_name", "subject").collect()]
    assert got == [("c", f"s{i:02}") for i in range(10)] + [("d", "only")]
    report = {r.check_name: (r.status, r.detail) for r in assertions.summarise(found, ["c", "d", "e"]).collect()}
    assert report == {"c": ("FAIL", "30 of 30 failed"), "d": ("FAIL", "1 of 2 failed"), "e": ("SKIP", "nothing to check")}


def test_digests_differ_per_column_only(spark, sf_dir):
    parts = star.frame(spark, sf_dir, "dim_part")
    clean = profile.column_digests(parts, "l", "dim_part")
    wrong = profile.column_digests(planted.plant(parts, {"part_size": "part_size + 1"}), "r", "dim_part")
    differing = checks.value_digests(clean, wrong).where("NOT ok").collect()
    assert [r.subject for r in differing] == ["dim_part.part_size"]


def test_changed_rows_are_added_by_all_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 90, 1, 3).selectExpr("CAST(id AS INT) AS region_key", "CAST(id AS STRING) AS region_name")
    rows.write.parquet(str(tmp_path / "dim_region"))
    monkeypatch.setattr(queries_checks.staging, "stored", lambda *_: str(tmp_path / "dim_region"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        path = queries_checks._second_file(spark, "", "dim_region", lambda df: df.selectExpr("CAST(region_key AS BIGINT) AS region_key", "region_name"))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = queries_checks.footers.stored_footers(spark, {"dim_region": path}).where("column_name = 'region_key'")
    assert {r.stored_type: r["count"] for r in files.groupBy("stored_type").count().collect()} == {"int": 3, "bigint": 3}


def test_registered_tables_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    asked = []

    def stored_all(_, sf_dir, tables):
        asked.append(tuple(tables))
        return {t: str(tmp_path / t) for t in tables}

    monkeypatch.setattr(queries_ingest.staging, "stored_all", stored_all)
    monkeypatch.setattr(queries_ingest.staging, "stored", lambda *_: pytest.fail("loaded one by one"))
    database = queries_ingest.published(spark, "none", "sidebyside", ("dim_region", "dim_nation"))
    assert asked == [("dim_region", "dim_nation")]
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


@pytest.fixture
def two_tables(spark, tmp_path):
    """A folder with customers and nations."""
    spark.sql("SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name, CAST(0 AS INT) AS n_regionkey FROM range(3)").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql(
        "SELECT id AS c_custkey, concat('C, ', id) AS c_name, CAST(id % 3 AS INT) AS c_nationkey, "
        "if(id % 4 = 0, NULL, id - 20.5D) AS c_acctbal, if(id % 5 = 0, NULL, 'M') AS c_mktsegment FROM range(40)"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def folders(spark):
    top = f"{session.scratch_root(spark)}/lakeproof/{spark.sparkContext.applicationId}"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_a_passing_table_leaves_no_staging(spark, two_tables):
    before = folders(spark)
    wanted = star.frame(spark, two_tables, "dim_customer")
    with staging.passing(spark, two_tables, "dim_customer") as stored:
        assert {f.rsplit("-", 1)[0] for f in folders(spark) - before} == {"passing-lake-dim_customer"}
        assert stored.exceptAll(wanted).isEmpty() and wanted.exceptAll(stored).isEmpty()
    assert folders(spark) == before
    with pytest.raises(ValueError), staging.passing(spark, two_tables, "dim_customer"):
        raise ValueError
    assert folders(spark) == before
    kept = staging.stored(spark, two_tables, "dim_customer")
    there = folders(spark)
    with staging.passing(spark, two_tables, "dim_customer") as stored:
        assert stored.inputFiles()[0].startswith(f"file://{kept}") and stored.count() == 40
    assert folders(spark) == there and session.exists(spark, kept)


def test_copies_are_compared_without_keeping_the_staging(spark, two_tables, monkeypatch):
    monkeypatch.setattr(queries_checks, "_COPIED", ("dim_nation", "dim_customer"))
    before = folders(spark)
    rows = {r.side: (r.status, r.checked, r.failed) for r in queries_checks.check_copies_agree(spark, two_tables).collect()}
    assert rows == {"clean": ("PASS", 4, 0), "planted": ("FAIL", 5, 2)}
    assert {f.split("-")[0] for f in folders(spark) - before} == {"original", "copied"}
