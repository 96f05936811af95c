"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from lakeproof.plans import catalogue
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    assert differences(spark, sf_dir, name) == []


@pytest.mark.parametrize("name", ["convert_delimited", "ragged_rows", "scan_multi_line", "key_findings", "hierarchy_cycles"])
def test_query_agrees_on_larger_tables(spark, name):
    """Those whose defects depend on values that the smallest tables may not hold."""
    assert differences(spark, "/root/testdata/sf0.01", name) == []


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).columns == ["order_status", "n", "total"]


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
