from __future__ import annotations

import dataclasses
import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeproof.session import local_frame, new_scratch, scratch_root
from lakeproof.sources import constraints, delimited, footers, lake, specs
from lakeproof.sources.specs import PinnedColumn, TableSpec

ITEMS = TableSpec(
    "dbo.Items",
    "items",
    (
        PinnedColumn("ItemKey", "item_key", "int", nullable=False),
        PinnedColumn("ItemName", "item_name", "nvarchar"),
        PinnedColumn("ListPrice", "list_price", "money"),
        PinnedColumn("Photo", "photo", "varbinary"),
        PinnedColumn("SoldFlag", "sold_flag", "bit"),
        PinnedColumn("SoldOn", "sold_on", "datetime"),
    ),
    multi_line=True,
)
HEADER = "ItemKey,ItemName,ListPrice,Photo,SoldFlag,SoldOn\n"


def file_of(tmp_path, body: str) -> str:
    path = tmp_path / "items.csv"
    path.write_bytes((HEADER + body).encode())
    return str(path)


def test_pinned_scan_keeps_tokens_and_nulls_only_empties(spark, tmp_path):
    path = file_of(
        tmp_path,
        '1,NA,12.3400,0xFF,1,2024-01-02 03:04:05.5\n2,null,,,0,\n3,"",-1,,,\n4,"a ""b""\nc,d",0.5,,1,\n5,\x00,1,,0,\n6, pad ,1,,0,\n',
    )
    df = delimited.pinned_scan(spark, path, ITEMS)
    assert df.columns == ["item_key", "item_name", "list_price", "sold_flag", "sold_on"]
    assert [f.nullable for f in df.schema] == [False, True, True, True, True]
    rows = df.orderBy("item_key").collect()
    assert [r.item_name for r in rows] == ["NA", "null", None, 'a "b"\nc,d', "", " pad "]
    assert [str(r.list_price) if r.list_price is not None else None for r in rows][:4] == ["12.3400", None, "-1.0000", "0.5000"]
    assert [r.sold_flag for r in rows][:4] == [True, False, None, True]
    assert rows[0].sold_on.microsecond == 500000


def test_raw_text_sees_empties_as_empties(spark, tmp_path):
    path = file_of(tmp_path, '1,,,,,\n2,"",1,,,\n3,NA,,,,\n')
    rows = delimited.text_columns(spark, path, ITEMS).orderBy("item_key").collect()
    assert [r.item_name for r in rows] == ["", "", "NA"]


@pytest.mark.parametrize("body", ["1,a,12.34565,,,\n", "x,a,1,,,\n", ",a,1,,,\n", "1,a,1,,maybe,\n", "1,a,1,,1,2024\n"])
def test_bad_values_fail_the_load(spark, tmp_path, body):
    with pytest.raises(PySparkException) as err:
        delimited.pinned_scan(spark, file_of(tmp_path, body), ITEMS).collect()
    assert err.value.getCondition() == "USER_RAISED_EXCEPTION"


def test_extract_round_trip(spark):
    rows = [(1, 'q"uo,te\nnew', None, None, True, None), (2, "\x00", None, None, False, None), (3, "", None, None, None, None)]
    df = local_frame(
        spark, rows, "item_key int, item_name string, list_price decimal(19,4), photo binary, sold_flag boolean, sold_on timestamp_ntz"
    )
    path = delimited.write_extract(df, new_scratch(spark, "roundtrip"), ITEMS)
    got = delimited.pinned_scan(spark, path, ITEMS).orderBy("item_key").collect()
    # '' and NULL are one and the same in the text, and a NUL-only field is ''.
    assert [r.item_name for r in got] == ['q"uo,te\nnew', "", None]
    raw = delimited.text_columns(spark, path, ITEMS).orderBy("item_key").collect()
    assert [r.item_name for r in raw] == ['q"uo,te\nnew', "\x00", ""]


def test_inferred_types_drift(spark, tmp_path):
    path = file_of(tmp_path, "1,7,12.5,,1,2024-01-02 03:04:05\n")
    drift = {r.column_name: (r.inferred, r.pinned) for r in delimited.schema_drift(spark, path, ITEMS).collect()}
    assert drift["item_name"] == ("int", "string")
    assert drift["list_price"] == ("double", "decimal(19,4)")
    assert drift["sold_flag"] == ("int", "boolean")
    assert "item_key" not in drift


@pytest.mark.parametrize(
    "cells, want",
    [
        (["1", "-7", None, ""], "int"),
        (["1", "3000000000"], "bigint"),
        (["3000000000", "9" * 30], "decimal(38,0)"),
        (["1", "9" * 50], "double"),
        (["9" * 30, "1e5", "NaN"], "double"),
        (["2024-02-29"], "date"),
        (["2024-02-29", "2024-02-29 10:00:00.5", "2024-02-29T10:00:00Z"], "timestamp"),
        (["2023-02-29"], "string"),
        (["true", "FALSE"], "boolean"),
        (["true", "1"], "string"),
        (["2024-02-28", "1"], "string"),
        (["1", "x"], "string"),
        (["", None], "string"),
        ([], "string"),
    ],
)
def test_the_least_type_that_holds_all_cells(spark, cells, want):
    raw = spark.createDataFrame([(c, "1") for c in cells], "a string, `b c` string")
    got = {r.column_name: (r.inferred, r.cells) for r in delimited.inferred_types(raw.repartition(3)).collect()}
    assert got == {"a": (want, sum(bool(c) for c in cells)), "b c": ("int" if cells else "string", len(cells))}


def test_inferred_types_take_one_scan(spark, tmp_path):
    path = file_of(tmp_path, "1,7,12.5,,1,2024-01-02 03:04:05\n2,x,3,,0,\n")
    single = dataclasses.replace(ITEMS, multi_line=False)
    plan = delimited.schema_drift(spark, path, single)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] csv") == 1 and plan.count("Aggregate [") == 1
    rows = delimited.inferred_scan(spark, path, ITEMS).orderBy("item_key").collect()
    assert [(r.item_key, r.item_name, r.list_price, r.sold_flag) for r in rows] == [(1, "7", 12.5, 1), (2, "x", 3.0, 0)]


def test_convert_and_audit(spark, tmp_path):
    source = tmp_path / "piped"
    source.write_bytes(b'1|a,b|x\n\n2|q"q|y\n3|short\n4|a|b|long\n5||\xff\n')
    target = delimited.convert_delimited(spark, str(source), new_scratch(spark, "converted"), ["A", "B", "C"])
    audit = delimited.ragged_rows(spark, target, ["A", "B", "C"]).first()
    assert (audit.rows, audit.ragged) == (5, 2)
    rows = {r.A: r for r in spark.read.csv(target, header=True, escape='"').collect()}
    assert rows["1"].B == "a,b" and rows["2"].B == 'q"q' and rows["5"].B is None and rows["5"].C == "�"


def test_ragged_rows_parses_instead_of_counting_lines(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('A,B\n1,"two\nlines"\n2\n3,a,b\n4,x\n')
    audit = delimited.ragged_rows(spark, str(path), ["A", "B"], multi_line=True).first()
    assert (audit.rows, audit.ragged) == (4, 2)


def test_catalog_from_documents(spark, tmp_path):
    for stem, columns in {"DimA": ["AKey", "APic"], "FactB": ["BKey"]}.items():
        doc = {
            "source_table": f"dbo.{stem}",
            "table": stem.lower(),
            "columns": [
                {
                    "source_name": c,
                    "name": c.lower(),
                    "sql_type": "image" if c == "APic" else "decimal",
                    "max_length": None,
                    "precision": 9,
                    "scale": 2,
                    "nullable": c == "APic",
                }
                for c in columns
            ],
        }
        (tmp_path / f"{stem}.json").write_text(json.dumps(doc, indent=2))
    catalog = specs.read_catalog(spark, str(tmp_path))
    assert catalog.count() == 3 and specs.kept_columns(catalog).count() == 2
    loaded = {s.table: s for s in specs.specs_from_catalog(catalog)}
    assert [c.name for c in loaded["dima"].columns] == ["akey", "apic"]
    assert loaded["dima"].kept[0].stored.simpleString() == "decimal(9,2)"
    assert not loaded["dima"].kept[0].nullable


def test_constraints_from_document(spark, tmp_path):
    doc = {
        "note": "x",
        "foreign_keys": [
            {"constraint": "FK_1", "from_table": "a", "from_columns": ["x", "y"], "to_table": "b", "to_columns": ["p", "q"]}
        ],
    }
    path = tmp_path / "fk.json"
    path.write_text(json.dumps(doc))
    row = constraints.read_constraints(spark, str(path)).first()
    assert (row.constraint_name, row.from_columns, row.to_columns) == ("FK_1", ["x", "y"], ["p", "q"])


def test_failed_refresh_leaves_the_table(spark):
    path = new_scratch(spark, "rollback")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    lake.full_refresh(spark.range(3).toDF("k"), database, "t", path)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("k"))
    with pytest.raises(PySparkException):
        lake.full_refresh(bad, database, "t", path)
    assert spark.table(f"{database}.t").count() == 3
    assert len(list(Path(path, "t").iterdir())) == 1
    for n in (4, 6, 7):
        at = lake.full_refresh(spark.range(n).toDF("k"), database, "t", path)
        assert spark.table(f"{database}.t").count() == n and lake.location(spark, database, "t").endswith(at)
    assert len(list(Path(path, "t").iterdir())) == 2
    lake.full_refresh(spark.range(5).selectExpr("id AS k", "'x' AS s"), database, "t", path)
    assert spark.table(f"{database}.t").columns == ["k", "s"]
    lake.drop_views(spark, database)
    assert database not in [r.schema_name for r in lake.list_schemas(spark).collect()]


def test_stored_schema_keeps_not_null(spark):
    path = new_scratch(spark, "flags")
    spark.range(2).selectExpr("id AS k", "CAST(NULL AS STRING) AS s").write.parquet(path)
    found = lambda: {r.column_name: (r.stored_type, r.required) for r in footers.stored_catalog(spark, {"t": path}).collect()}
    assert found() == {"k": ("bigint", True), "s": ("string", False)}
    spark.range(2).selectExpr("CAST(NULL AS INT) AS k").write.mode("append").parquet(path)
    assert found() == {"k": ("bigint or int", False), "s": ("string or absent", False)}


def test_scan_raises_on_a_null_in_a_required_column(spark):
    path = new_scratch(spark, "null")
    local_frame(
        spark,
        [(1,), (None,)],
        "item_key int",
    ).selectExpr("item_key", "CAST(NULL AS STRING) item_name", "0.0BD list_price", "true sold_flag", "TIMESTAMP_NTZ '2024-01-01 00:00:00' sold_on").selectExpr(
        "item_key", "item_name", "CAST(list_price AS DECIMAL(19,4)) list_price", "sold_flag", "sold_on"
    ).write.parquet(path)
    with pytest.raises(PySparkException):
        lake.scan(spark, path, ITEMS).collect()


def test_param_sql_limit(spark):
    assert lake.param_sql(spark, "SELECT * FROM range(50) WHERE id >= ?", [10], limit=5).count() == 5
    assert lake.param_sql(spark, "SELECT * FROM range(50)", limit=None).count() == 50
    assert lake.param_sql(spark, "SELECT * FROM range(50)", limit=0).count() == 50


def test_run_summary(spark):
    log = local_frame(
        spark,
        [
            ("a", 1, "t1", 10, 1.0), ("a", 1, "t2", 20, 2.0), ("a", 1, "__total__", 30, 4.0),
            ("a", 2, "t1", 10, 2.0), ("a", 2, "t2", 20, 3.0), ("a", 2, "__total__", 30, 6.0),
            ("b", 1, "t1", 5, 1.5),
        ],
        "loader string, run_id int, table_name string, rows bigint, seconds double",
    )
    got = {r.loader: tuple(r)[1:] for r in lake.run_summary(log).collect()}
    assert tuple(map(float, got["a"])) == (2, 2, 30, 5, 4)
    # Without a total there is no run to average over.
    assert tuple(map(float, got["b"])) == (0, 0, 0, 0, 0)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"
        applicationId = "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_root(Session())


def test_select_tables(spark):
    available = local_frame(spark, [("a",), ("b",), ("DatabaseLog",)], "table_name string")
    got = lambda *a: {tuple(r) for r in specs.select_tables(available, *a).collect()}
    assert got([], ("DatabaseLog",)) == {("a", "selected"), ("b", "selected")}
    assert got(["b", "z", "b"], ("DatabaseLog",)) == {("b", "selected"), ("z", "missing")}


def test_jdbc_writer_options():
    options = lake.jdbc_options({"user": "x"}, connections=4)
    assert options == {"batchsize": "50000", "numPartitions": "4", "user": "x"}


@pytest.mark.parametrize("lines, error", [(["2,x"], "fields"), (["2,x,y,z"], "fields"), ([], None)])
def test_scan_matches_by_name_and_refuses_ragged_rows(spark, tmp_path, lines, error):
    spec = TableSpec("T", "t", tuple(PinnedColumn(n, n.lower(), "nvarchar") for n in "ABC"))
    path = tmp_path / "t.csv"
    path.write_text("\n".join(["A,C,B", "1,c,b", *lines, ""]))
    df = delimited.fields(spark, str(path), spec)
    if error is None:
        assert [tuple(r) for r in df.select("a", "b", "c").collect()] == [("1", "b", "c")]
        return
    for run in (df.count, df.select("a").collect):
        with pytest.raises(Exception, match=error):
            run()


def test_extracts_are_packed_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "EXTRACT_ROWS", 10)
    spec = TableSpec("T", "t", (PinnedColumn("A", "a", "bigint"), PinnedColumn("B", "b", "nvarchar")))
    df = spark.range(0, 35, 1, 1).selectExpr("id AS a", "if(id % 3 = 0, NULL, concat('x \"', id, '\", ')) AS b")
    path = delimited.write_extract(df, str(tmp_path / "t"), spec)
    files = list(Path(path).glob("part-*"))
    assert len(files) == 4 and all(f.suffix == ".lz4" for f in files)
    assert sorted(map(tuple, delimited.pinned_scan(spark, path, spec).collect())) == sorted(map(tuple, df.collect()))
