"""What fails in one table stays with that table, and is measured once."""

from __future__ import annotations

import dataclasses
from collections import Counter

import pytest

from lakeproof.functions import casting
from lakeproof.plans import queries_checks, star, verify
from lakeproof.session import new_scratch
from lakeproof.sources import delimited
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def dataset(spark, sf_dir):
    return queries_checks.dataset(spark, sf_dir)


def edited(spark, dataset, table, change):
    """The dataset with one extract's lines changed."""
    path = new_scratch(spark, "edited")
    lines = spark.read.text(dataset.extracts[table]).collect()
    header = next(r.value for r in lines if r.value.startswith(star.SPECS[table].kept[0].source_name))
    body = change([r.value for r in lines if r.value != header])
    spark.createDataFrame([("\n".join([header, *body]),)], "value string").coalesce(1).write.text(path)
    return dataclasses.replace(dataset, extracts={**dataset.extracts, table: path})


def failures(spark, dataset, names):
    found = verify.Verification(spark, dataset).assertions(names).where("NOT ok").collect()
    return {(r.check_name, r.subject): r.actual for r in found}


PROFILED = ["row_counts", "null_reconciliation", "value_digests", "decimal_exactness", "source_values"]


def test_one_bad_cell_fails_its_table_alone(spark, dataset):
    def spoil(lines):
        cells = lines[0].split(",")
        cells[[c.name for c in star.SPECS["dim_supplier"].columns].index("account_balance")] = "12,5x".replace(",", ".")
        return [",".join(cells), *lines[1:]]

    found = failures(spark, edited(spark, dataset, "dim_supplier", spoil), PROFILED)
    assert {c for c, _ in found} == {"value_digests", "decimal_exactness"}
    assert {s.split(" ")[0] for _, s in found} == {"dim_supplier.account_balance"}
    assert found["value_digests", "dim_supplier.account_balance refused fields"] == "1"


def test_a_ragged_extract_is_one_finding_of_each_check(spark, dataset):
    found = failures(spark, edited(spark, dataset, "dim_supplier", lambda lines: [lines[0] + ",more", *lines[1:]]), PROFILED)
    assert set(found) == {(c, "dim_supplier source") for c in PROFILED}


def test_a_table_never_loaded_stops_nothing(spark, dataset):
    some = dataclasses.replace(dataset, stored={t: p for t, p in dataset.stored.items() if t != "dim_region"})
    names = ["row_counts", "types", "primary_keys", "referential_integrity", "nullability_enforced", "hierarchies"]
    found = failures(spark, some, names)
    assert ("row_counts", "dim_region lake") in found and "has not been loaded" in found["row_counts", "dim_region lake"]
    assert {s for c, s in found if c == "referential_integrity" and "not loaded" in found[c, s]} == {"dim_nation.region_key -> dim_region.region_key"}
    assert ("primary_keys", "dim_region.region_key") in found
    assert {c for c, _ in found} <= {"row_counts", "types", "primary_keys", "referential_integrity"}


def test_each_extract_is_parsed_once(spark, dataset, monkeypatch):
    parsed = Counter()
    original = delimited.fields
    monkeypatch.setattr(delimited, "fields", lambda s, path, spec: (parsed.update([spec.table]), original(s, path, spec))[1])
    gone = dataclasses.replace(dataset, extracts={**dataset.extracts, "dim_part": "/nowhere"})
    verify.Verification(spark, gone).assertions([*PROFILED, "known_baseline", "nullability_flags"])
    assert parsed == Counter(dict.fromkeys(star.SPECS, 1))


def test_without_declarations_the_oracle_is_skipped(spark, dataset):
    undeclared = dataclasses.replace(dataset, declared=None)
    report = verify.report(verify.Verification(spark, undeclared).assertions(["foreign_key_oracle"]), ["foreign_key_oracle"])
    assert [r.status for r in report.collect()] == ["SKIP"]
    assert verify.exit_code(report, strict=True) == 1


@pytest.mark.parametrize(
    "text, of, fits",
    [
        ("2024-01-02 03:04:05.123456", T.TimestampNTZType(), True),
        ("2024-01-02 03:04:05.1234560", T.TimestampNTZType(), True),
        ("2024-01-02 03:04:05.1234567", T.TimestampNTZType(), False),
        ("03:04:05.123456", T.TimeType(6), True),
        ("03:04:05.1234567", T.TimeType(6), False),
        ("25:00:00", T.TimeType(6), False),
    ],
)
def test_times_fit_their_microseconds(spark, text, of, fits):
    df = spark.createDataFrame([(text,)], "t string")
    assert (df.selectExpr(casting.parsed("t", of)).first()[0] is not None) == fits
    strict = df.selectExpr(casting.strict_cast("t", of, "x"))
    if fits:
        strict.collect()
    else:
        with pytest.raises(Exception, match="not a"):
            strict.collect()
