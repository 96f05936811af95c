"""From schema documents and CSV files to a verified lake, as a user would."""

from __future__ import annotations

import json

import pytest

from lakeproof.operators import assertions
from lakeproof.plans import verify
from lakeproof.plans.warehouse import Warehouse
from lakeproof.session import new_scratch

TABLES = {
    "DimTerritory": (["TerritoryKey int!", "TerritoryName nvarchar!", "Picture image"], "1,NA,\n2,\x00,\n3,North,\n"),
    "DimEmployee": (["EmployeeKey int!", "ParentEmployeeKey int", "TerritoryKey int"], "1,,1\n2,1,2\n3,2,\n"),
    "DimDate": (["DateKey int!", "FullDateAlternateKey date!"], "20240101,2024-01-01\n20240102,2024-01-02\n"),
    "FactSales": (
        ["SalesOrderNumber nvarchar!", "SalesOrderLineNumber tinyint!", "EmployeeKey int!", "OrderDateKey int!", "SalesAmount money!", "RegionId nvarchar"],
        "S1,1,1,20240101,10.2500,NA\nS1,2,2,20240102,0.7500,North\nS2,1,2,20240102,5,\n",
    ),
    "FactSalesReason": (["SalesOrderNumber nvarchar!", "SalesOrderLineNumber tinyint!"], "S1,2\nS2,1\n"),
    "DatabaseLog": (["LogKey int!"], "1\n"),
}
KEYS = [
    ("FK_1", "dim_employee", ["parent_employee_key"], "dim_employee", ["employee_key"]),
    ("FK_2", "dim_employee", ["territory_key"], "dim_territory", ["territory_key"]),
    ("FK_3", "fact_sales", ["employee_key"], "dim_employee", ["employee_key"]),
    ("FK_4", "fact_sales_reason", ["sales_order_number", "sales_order_line_number"], "fact_sales", ["sales_order_number", "sales_order_line_number"]),
]
KNOWN = {"rows": 13, "tables": 5, "columns": 15, "constraints": 4, "composites": 1}
CURATED = [("fact_sales", ("region_id",), "dim_territory", ("territory_name",))]


def snake(name):
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")


def write(folder, overrides=()):
    for part in ("schemas", "data"):
        (folder / part).mkdir()
    for table, (columns, body) in TABLES.items():
        doc = {"source_table": f"dbo.{table}", "table": snake(table), "columns": []}
        for c in columns:
            name, kind = c.split(" ")
            doc["columns"].append(
                {"source_name": name, "name": snake(name), "sql_type": kind.rstrip("!"), "max_length": None,
                 "precision": None, "scale": None, "nullable": not kind.endswith("!")}
            )
        (folder / "schemas" / f"{table}.json").write_text(json.dumps(doc, indent=2))
        header = ",".join(c.split(" ")[0] for c in columns)
        (folder / "data" / f"{table}.csv").write_text(header + "\n" + dict(overrides).get(table, body))
    names = ("constraint", "from_table", "from_columns", "to_table", "to_columns")
    (folder / "fk.json").write_text(json.dumps({"foreign_keys": [dict(zip(names, k)) for k in KEYS]}))


def open_warehouse(spark, folder) -> Warehouse:
    root = new_scratch(spark, "warehouse")
    database = root.rsplit("/", 1)[1].replace("-", "_")
    return Warehouse(
        spark, str(folder / "schemas"), str(folder / "data"), root, database, str(folder / "fk.json"), CURATED
    )


def test_load_copy_view_and_verify(spark, tmp_path):
    write(tmp_path)
    w = open_warehouse(spark, tmp_path)
    log = {r.table_name: (r.rows, r.error) for r in w.load().collect()}
    assert log == {t: (n, None) for t, n in
                   {"dim_territory": 3, "dim_employee": 3, "dim_date": 2, "fact_sales": 3, "fact_sales_reason": 2}.items()}
    territories = {r.territory_key: r.territory_name for r in w.table("dim_territory").collect()}
    assert territories == {1: "NA", 2: "", 3: "North"}
    views = {r.view_name: r.n_columns for r in w.publish_views(f"{w.database}_views").collect()}
    assert views["fact_sales"] == 6
    w.copy(f"{w.database}_copy", f"{w.root}-copy").collect()
    report, found = w.verify(KNOWN, copies=[f"{w.database}_copy", f"{w.database}_views"])
    assert {r.check_name: r.status for r in report.collect() if r.status != "PASS"} == {}
    assert assertions.findings(found).count() == 0
    assert verify.exit_code(report, strict=True) == 0
    probe = w.probe("fact_sales", "employee_key", "sales_amount", {"copy": spark.table(f"{w.database}_copy.fact_sales")})
    assert probe.where("NOT ok").count() == 0 and probe.count() == 2


def test_a_bad_extract_fails_its_table_only(spark, tmp_path):
    write(tmp_path, {"DimDate": "20240101,yesterday\n"}.items())
    w = open_warehouse(spark, tmp_path)
    log = {r.table_name: r.error for r in w.load().collect()}
    assert "dim_date.full_date_alternate_key: not a date: yesterday" in log.pop("dim_date")
    assert set(log.values()) == {None}
    # The verification goes on without the table and names it in the checks that need it.
    _, found = w.verify(KNOWN, ["row_counts", "value_digests", "primary_keys"])
    bad = {(r.check_name, r.subject) for r in found.where("NOT ok").collect()}
    assert bad == {
        ("row_counts", "dim_date lake"), ("value_digests", "dim_date lake"), ("primary_keys", "dim_date.date_key"),
    }


def test_defects_are_found(spark, tmp_path):
    write(tmp_path, {"FactSalesReason": "S1,2\nS9,1\n", "DimEmployee": "1,3,1\n2,1,2\n3,2,9\n"}.items())
    w = open_warehouse(spark, tmp_path)
    w.load().collect()
    report, found = w.verify(KNOWN)
    bad = {r.check_name for r in report.where("status = 'FAIL'").collect()}
    assert bad == {"referential_integrity", "hierarchies"}
    subjects = {r.subject for r in assertions.findings(found).where("check_name = 'referential_integrity'").collect()}
    assert subjects == {
        "dim_employee.territory_key -> dim_territory.territory_key",
        "fact_sales_reason.sales_order_number+sales_order_line_number -> fact_sales.sales_order_number+sales_order_line_number",
    }


def test_subset_and_unknown_names(spark, tmp_path):
    write(tmp_path)
    w = open_warehouse(spark, tmp_path)
    got = {tuple(r) for r in w.select(["dim_date", "dim_nothing"]).collect()}
    assert got == {("dim_date", "selected"), ("dim_nothing", "missing")}
    assert [r.table_name for r in w.load(["dim_date"]).collect()] == ["dim_date"]
