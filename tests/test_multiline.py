"""Records with line breaks: the same rows however the file is split."""

from __future__ import annotations

import csv
import io
import random

import pytest

from lakeproof.plans import staging, star
from lakeproof.sources import delimited, multiline


@pytest.fixture
def split_bytes(spark, request):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def odd_rows() -> list[list[str]]:
    draw = random.Random(11)
    words = ["", "a", 'he said "no"', "one\ntwo", "\n", '"', '\n"\n"', "x,y", "é\n日本", "long " * 60 + "\n" + "tail " * 40, "cr\r\nlf", " blank "]
    return [["1", *[draw.choice(words) for _ in range(2)]] for _ in range(80)]


@pytest.mark.parametrize("split_bytes", [97, 1 << 27], indirect=True)
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_any_split_gives_the_same_rows(spark, tmp_path, split_bytes, ending):
    rows = odd_rows()
    for part in range(2):
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=ending).writerows([["K", "T", "U"], *rows[40 * part : 40 * part + 40]])
        (tmp_path / f"{part}.csv").write_bytes(out.getvalue().encode())
    got = delimited.parsed_rows(spark, str(tmp_path), ["K", "T", "U"], multi_line=True)
    assert sorted([c or "" for c in r[:3]] for r in got.collect()) == sorted(rows)
    assert got.where("_ragged IS NOT NULL").isEmpty()
    n = multiline.splits(spark, str(tmp_path)).count()
    assert n >= (2 if split_bytes > 10**6 else 10)


@pytest.mark.parametrize("split_bytes", [50], indirect=True)
def test_ragged_rows_and_headers(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_text('A,B\n1,"x\ny"\n\n2\n3,"u\n\nv",w\n4,z')
    audit = delimited.ragged_rows(spark, str(tmp_path), ["A", "B"], multi_line=True).first()
    assert (audit.rows, audit.ragged) == (4, 2)
    (tmp_path / "b.csv").write_text("A,C\n5,z\n")
    with pytest.raises(Exception, match="header differs"):
        delimited.ragged_rows(spark, str(tmp_path), ["A", "B"], multi_line=True).collect()


@pytest.mark.parametrize("split_bytes", [40_000], indirect=True)
def test_a_multi_line_file_is_parsed_by_several_tasks(spark, sf_dir, split_bytes):
    path = staging.extract(spark, sf_dir, "dim_document")
    scan = delimited.text_columns(spark, path, star.SPECS["dim_document"])
    assert multiline.splits(spark, path).count() > 3 and scan.rdd.getNumPartitions() > 3
    want = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert scan.count() == want
