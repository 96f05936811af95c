"""Operators against brute force on small, awkward data."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeproof.operators import edges as rel
from lakeproof.operators import hierarchy, joins, keys, profile, reconcile
from lakeproof.plans import queries_profile
from lakeproof.session import local_frame, settle, settle_all
from lakeproof.sources import specs


def test_key_audit_against_brute_force(spark):
    rng = random.Random(1)
    # A third of all rows share one key, some keys are NULL.
    rows = [(7 if rng.random() < 0.35 else rng.choice([None, *range(60)]), rng.choice([None, "a", "b"])) for _ in range(3000)]
    df = local_frame(spark, rows, "a bigint, b string")
    empty = df.where("false")
    audit = keys.key_audit({"t": df, "e": empty}, [("t", ("a",)), ("t", ("a", "b")), ("e", ("a",))]).collect()
    got = {(r.table_name, r.key_name): (r.rows, r.surplus, r.null_rows) for r in audit}
    single = Counter(a for a, _ in rows)
    pair = Counter(rows)
    assert got["t", "a"] == (3000, 3000 - len(single), single[None])
    assert got["t", "a+b"] == (3000, 3000 - len(pair), sum(a is None or b is None for a, b in rows))
    assert got["e", "a"] == (0, 0, 0)


def edges_of(*triples):
    return [(c, tuple(fk), p, tuple(pk)) for c, fk, p, pk in triples]


def brute_edge(child, parent):
    whole = [k for k in child if all(x is not None for x in k)]
    targets = set(parent)
    orphans = [k for k in whole if k not in targets]
    return len(whole), len(set(orphans)), len(orphans), len(parent) - len(targets)


def test_edge_audit_against_brute_force(spark):
    rng = random.Random(2)
    child = [(5 if rng.random() < 0.35 else rng.choice([None, *range(80)]), rng.choice([None, 1, 2])) for _ in range(2000)]
    parent = [(rng.choice([None, *range(60)]), rng.choice([1, 2])) for _ in range(90)]
    frames = {
        "c": local_frame(spark, child, "x int, y int"),
        "p": local_frame(spark, parent, "k bigint, l bigint"),
        "none": local_frame(spark, [], "k bigint"),
    }
    edges = edges_of(("c", ["x"], "p", ["k"]), ("c", ["x", "y"], "p", ["k", "l"]), ("c", ["x"], "none", ["k"]))
    got = [tuple(r)[1:] for r in keys.edge_audit(frames, edges).collect()]
    by_name = dict(zip([r.edge for r in keys.edge_audit(frames, edges).collect()], got))
    assert by_name["c.x -> p.k"] == brute_edge([(x,) for x, _ in child], [(k,) for k, _ in parent])
    assert by_name["c.x+y -> p.k+l"] == brute_edge(child, parent)
    assert by_name["c.x -> none.k"] == brute_edge([(x,) for x, _ in child], [])
    wide = Counter(k for k, _ in parent)
    fan = {r.edge: (r.rows_before, r.rows_after) for r in keys.join_fanout(frames, edges[:1]).collect()}
    assert fan["c.x -> p.k"] == (2000, sum(wide[x] for x, _ in child if x is not None))


def test_edges_between_number_and_text(spark):
    frames = {"c": local_frame(spark, [(1,), (2,)], "x int"), "p": local_frame(spark, [("1",)], "k string")}
    row = keys.edge_audit(frames, edges_of(("c", ["x"], "p", ["k"]))).first()
    assert (row.compared, row.orphan_keys) == (2, 1)


def test_orphan_examples_come_in_key_order(spark):
    frames = {"c": local_frame(spark, [(9,), (3,), (3,), (5,), (1,), (None,)], "x int"), "p": local_frame(spark, [(1,)], "k int")}
    got = [tuple(r) for r in keys.orphan_examples(frames, ("c", ("x",), "p", ("k",)), n=2).collect()]
    assert got == [(3, 2), (5, 1)]


def brute_cycles(parent):
    out = set()
    for start in parent:
        seen, node = set(), start
        while node is not None and node in parent:
            if node in seen:
                out.add(start)
                break
            seen.add(node)
            node = parent[node]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_cycles_in_random_graphs(spark, seed):
    rng = random.Random(seed)
    n = 60
    parent = {i: rng.choice([None, -1, *range(n)]) if rng.random() < 0.4 else (i // 2 if i else None) for i in range(n)}
    df = local_frame(spark, list(parent.items()), "k int, p int")
    # With a share of 5 only the most popular ancestors are hot, with 1000 all are.
    for share in (5, 1000):
        assert {r.node for r in hierarchy.cycle_starts(df, "k", "p", share).collect()} == brute_cycles(parent)


@pytest.mark.parametrize("seed", range(4))
def test_cycles_with_several_parents(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(70), rng.choice([None, *range(90)])) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(i, i + 2) for i in range(130, 140)]
    left = {e for e in edges if e[1] is not None}
    while (kept := {e for e in left if e[1] in {n for n, _ in left}}) != left:
        left = kept
    got = {r.node for r in hierarchy.cycle_starts(local_frame(spark, edges, "k int, p int"), "k", "p", 10).collect()}
    assert got == {n for n, _ in left}


def test_cycles_long_chain_self_parent_and_lead_in(spark):
    parent = {i: i - 1 if i else None for i in range(300)}
    parent |= {1000: 1001, 1001: 1000, 1002: 1000, 2000: 2000, 3000: 9999}
    df = local_frame(spark, list(parent.items()), "k int, p int")
    assert {r.node for r in hierarchy.cycle_starts(df, "k", "p").collect()} == {1000, 1001, 1002, 2000}
    assert {r.parent for r in hierarchy.dangling_parents(df, "k", "p").collect()} == {9999}


def test_no_hierarchy_at_all(spark):
    df = local_frame(spark, [(1, None), (2, None)], "k int, p int")
    assert hierarchy.cycle_starts(df, "k", "p").count() == 0


def test_repeated_natural_keys(spark):
    df = local_frame(spark, [("a", "b"), ("a", "c"), ("b", None), ("b", "c"), ("c", None), ("c", None)], "k string, p string")
    got = {r.node: (r.low, r.high) for r in hierarchy.conflicting_parents(df, "k", "p").collect()}
    assert got == {"a": ("b", "c"), "b": ("c", "c")}


def test_lookup_is_a_join_whatever_is_hot(spark):
    rng = random.Random(3)
    left = [(i, rng.choice([1, 1, 1, *range(20)])) for i in range(500)]
    right = [(k, k * 10) for k in range(0, 20, 2)] + [(1, 10)]
    a, b = local_frame(spark, left, "n int, k int"), local_frame(spark, right, "k int, v int")
    want = Counter((k, n, dict(right)[k]) for n, k in left if k in dict(right))
    for share in (1, 10, 10_000):
        got = Counter((r.k, r.n, r.v) for r in joins.lookup(a, b, "k", 500, share).collect())
        assert got == want


def test_cell_differences(spark):
    ddl = "k int, a int, b string"
    left = local_frame(spark, [(1, 1, "x"), (2, 2, "y"), (3, 3, None), (4, 4, "z")], ddl)
    right = local_frame(spark, [(1, 1, "x"), (2, 9, "q"), (3, 3, "n"), (5, 5, "z")], ddl)
    got = {(r.k, r.column_name, r.left_value, r.right_value) for r in reconcile.cell_differences(left, right, ["k"]).collect()}
    assert got == {
        (2, "a", "2", "9"),
        (2, "b", "y", "q"),
        (3, "b", None, "n"),
        (4, "(row)", "present", "absent"),
        (5, "(row)", "absent", "present"),
    }


def test_differences_do_not_multiply_on_a_hot_key(spark):
    left = spark.range(2000).selectExpr("CAST(1 AS INT) AS k", "id AS v")
    right = spark.range(1, 2001).selectExpr("CAST(1 AS INT) AS k", "id AS v")
    got = [tuple(r) for r in reconcile.cell_differences(left, right, ["k"]).collect()]
    assert got == [(1, "v", "0", "2000")]


def test_every_differing_row_of_a_repeated_key_is_shown(spark):
    ddl = "k int, a int, b string, c array<string>"
    left = local_frame(spark, [(1, 1, None, ["x", None]), (1, 2, "q", None), (1, 2, "q", None), (None, 7, "n", None)], ddl)
    right = local_frame(spark, [(1, 1, None, [None, "x"]), (1, 5, "q", None), (None, 8, "n", None)], ddl)
    got = sorted((str(r.k), r.column_name, r.left_value, r.right_value) for r in reconcile.cell_differences(left, right, ["k"]).collect())
    assert got == [
        ("1", "(row)", "present", "absent"),
        ("1", "a", "2", "5"),
        ("1", "c", "[x, null]", "[null, x]"),
        ("None", "a", "7", "8"),
    ]


def test_sums_differ_below_four_decimals(spark):
    def below(value: str) -> dict:
        df = spark.range(3).selectExpr(f"CAST({value} AS DECIMAL(18,6)) AS p", "CAST(1 AS DECIMAL(19,4)) AS m")
        found = profile.lake_profile(df, "t").where("metric IN ('sum', 'sum_below')").collect()
        return {(r.column_name, r.metric): r.value for r in found}

    one, other = below("-1.000010"), below("-1.000011")
    assert set(one) == {("p", "sum"), ("p", "sum_below"), ("m", "sum")}
    assert one["p", "sum"] == other["p", "sum"]
    assert (one["p", "sum_below"], other["p", "sum_below"]) == (-30, -33)


def test_diff_sample_takes_the_first_of_every_column(spark):
    left = spark.range(100).selectExpr("id AS k", "id AS a", "id AS b")
    right = left.selectExpr("k", "a + 1 AS a", "if(k > 50, -1, b) AS b")
    got = sorted((r.column_name, r.k) for r in reconcile.diff_sample(left, right, ["k"], n=2).collect())
    assert got == [("a", 0), ("a", 1), ("b", 51), ("b", 52)]


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS g", "id AS v")
    plan = reconcile.first_per_group(df, ["g"], ["v"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_profile_counts(spark):
    df = local_frame(spark, [("a", 1), ("", None), (None, 2), ("\x00", 3), ("NA", 4), ("b\x00", 5)], "s string, n int")
    got = {(r.column_name, r.metric): int(r.value) for r in profile.column_profile(df, "x", "t").collect()}
    assert got == {
        ("*", "rows"): 6, ("s", "nulls"): 1, ("n", "nulls"): 1,
        ("s", "empties"): 1, ("s", "nul_bytes"): 2, ("s", "nul_only"): 1,
    }
    assert [tuple(r)[2:] for r in profile.token_census(df, "x", "t").collect()] == [("s", "NA", 1)]


def wide(spark, n):
    """n columns of six types, with gaps, empties, tokens and NUL bytes."""
    makers = ["id * {i}", "CAST(id * 0.37 AS DECIMAL(12,2))", "CAST(id / 7 AS DECIMAL(20,9))", "id / {i}e0",
              "CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN char(0) WHEN 3 THEN concat('x', char(0)) ELSE 'y' END", "DATE'2024-01-01' + CAST(id AS INT)"]
    gaps = [f"if(id % 11 = {i % 11}, NULL, {makers[i % 6].format(i=i + 1)}) AS c{i}" for i in range(n)]
    return spark.range(0, 200, 1, 4).selectExpr(*gaps)


def test_a_wide_table_is_profiled_in_one_scan(spark, monkeypatch, tmp_path):
    wide(spark, 300).write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    stacked = profile.lake_profile(stored, "t")
    plan = stacked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    got = {(r.column_name, r.metric): r.value for r in stacked.collect()}
    monkeypatch.setattr(profile, "COLUMNS_AT_ONCE", 1000)
    side_by_side = {}
    for start in range(0, 300, 60):
        part = stored.select(*stored.columns[start : start + 60])
        side_by_side |= {(r.column_name, r.metric): r.value for r in profile.lake_profile(part, "t").collect()}
    assert got == side_by_side and len(got) > 1000
    assert sum(v != 0 for (_, m), v in got.items() if m == "sum_below") > 0


def test_a_wide_empty_table_has_zeros(spark, monkeypatch):
    monkeypatch.setattr(profile, "COLUMNS_AT_ONCE", 3)
    got = {r.value for r in profile.lake_profile(wide(spark, 8).where("false"), "t").collect()}
    assert got == {0}


def test_wide_cells_are_made_by_many_tasks(spark):
    """One row group is one task; without a line number nothing is cast."""
    rows = "if(id % 9 = 0, NULL, CAST(id % 9 AS INT)) AS line_number, if(id % 9 = 0, 1e30D, id / 8e0D) AS quantity"
    rest = "CAST(id AS DECIMAL(19,4)) AS extended_price, if(id % 5 = 0, NULL, id / 100e0D) AS discount_pct, id AS order_key"
    lines = spark.sql(f"SELECT {rows}, {rest} FROM range(0, 4000, 1, 1)")
    dealt = queries_profile.wide_lines(lines)
    filled = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(filled) > 1 and sum(r["count"] for r in filled) == 4000
    plain = lines.selectExpr(*specs.projection(queries_profile._WIDE))
    assert dealt.schema == plain.schema
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


@pytest.fixture
def ranges_kept(spark):
    """Small ranges are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_key_is_numbered_by_many_tasks(spark, ranges_kept):
    df = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 10 < 9, 1L, id) AS k", "id % 2 = 0 AS side", "named_struct('a', -id, 'b', NULL) AS cells")
    got = reconcile.numbered(df, ["k", "side"], ["cells"], "n")
    rows = {(r.k, r.side, -r.cells.a): r.n for r in got.collect()}
    want, seen = {}, {}
    for i in range(29_999, -1, -1):
        group = (1 if i % 10 < 9 else i, i % 2 == 0)
        seen[group] = seen.get(group, 0) + 1
        want[(*group, i)] = seen[group]
    assert rows == want
    ranged = df.repartitionByRange("k", "side", "cells").withColumn("p", F.spark_partition_id())
    assert ranged.where("k = 1").select("p").distinct().count() > 2


def test_sums_are_exact_and_zero_for_nothing(spark):
    df = spark.range(1000).selectExpr("CAST(0.1 AS DECIMAL(19,4)) AS m")
    assert profile.decimal_sums(df, "x", "t").first().value == Decimal("100.0000")
    assert profile.decimal_sums(df.where("false"), "x", "t").first().value == 0


def test_row_counts_of_empty_tables(spark):
    got = {r.table_name: r.rows for r in profile.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert got == {"a": 3, "b": 0}


def test_settled_frames_keep_every_row(spark):
    empty, full = (spark.range(n).selectExpr("id", "CAST(id AS STRING) AS s") for n in (0, 3))
    for frames in ([empty, empty, empty, full], [full, empty, empty, full], [empty, empty]):
        settled = settle_all([lambda df=df: df for df in frames])
        assert settled.count() == sum(df.count() for df in frames)
    assert sorted(r.id for r in settle(spark.range(100).repartition(20).where("id > 96")).collect()) == [97, 98, 99]


def test_reconcile_sees_both_sides(spark):
    ddl = "side string, table_name string, column_name string, metric string, value decimal(38,4)"
    one = Decimal("1.0000")
    left = local_frame(spark, [("l", "t", "a", "m", one), ("l", "t", "b", "m", one)], ddl)
    right = local_frame(spark, [("r", "t", "a", "m", one), ("r", "t", "c", "m", one)], ddl)
    got = {(r.column_name, r.left_value, r.right_value) for r in reconcile.differences(left, right).collect()}
    assert got == {("b", one, None), ("c", None, one)}


CATALOG = [
    ("dim_customer", "customer_key"), ("dim_customer", "parent_customer_key"), ("dim_customer", "customer_alternate_key"),
    ("dim_date", "date_key"),
    ("dim_account", "account_code_alternate_key"), ("dim_account", "parent_account_code_alternate_key"),
    ("dim_group", "parent_group_key"),
    ("fact_sales", "customer_key"), ("fact_sales", "order_date_key"), ("fact_sales", "sales_key"), ("fact_sales", "mystery_key"),
    ("fact_sales", "amount"),
]


def test_classification_rules(spark):
    got = {
        (r.table_name, r.column_name): (r.kind, r.to_table, r.to_column)
        for r in rel.classify_keys(local_frame(spark, CATALOG, "table_name string, column_name string")).collect()
    }
    assert got == {
        ("dim_customer", "customer_key"): ("own key", None, None),
        ("dim_customer", "parent_customer_key"): ("hierarchy", "dim_customer", "customer_key"),
        ("dim_customer", "customer_alternate_key"): ("natural key", None, None),
        ("dim_date", "date_key"): ("own key", None, None),
        ("dim_account", "account_code_alternate_key"): ("natural key", None, None),
        ("dim_account", "parent_account_code_alternate_key"): ("hierarchy", "dim_account", "account_code_alternate_key"),
        # Its own key is not among the columns, so the name decides.
        ("dim_group", "parent_group_key"): ("hierarchy", "dim_group", "group_key"),
        ("fact_sales", "customer_key"): ("dimension", "dim_customer", "customer_key"),
        ("fact_sales", "order_date_key"): ("date role", "dim_date", "date_key"),
        ("fact_sales", "sales_key"): ("own key", None, None),
        ("fact_sales", "mystery_key"): ("unclassified", None, None),
    }


def test_date_roles_need_a_date_dimension(spark):
    rows = [("fact_sales", "order_date_key")]
    kinds = rel.classify_keys(local_frame(spark, rows, "table_name string, column_name string")).collect()
    assert [r.kind for r in kinds] == ["unclassified"]


def test_edge_diff_and_minimality(spark):
    a = ("f", ("x",), "d", ("k",))
    b = ("f", ("y", "z"), "e", ("p", "q"))
    h = ("d", ("parent_k",), "d", ("k",))
    c = ("f", ("w",), "d", ("k",))
    frame = lambda *e: rel.edge_frame(spark, e)
    got = {(r.from_columns[0], r.verdict) for r in rel.edge_diff(frame(a, b, h), frame(a, c), frame(h)).collect()}
    assert got == {("x", "agreed"), ("y", "missed"), ("parent_k", "routed"), ("w", "invented")}
    swapped = ("f", ("z", "y"), "e", ("q", "p"))
    crossed = ("f", ("z", "y"), "e", ("p", "q"))
    reasons = [
        (tuple(r.from_columns), r.reason) for r in rel.not_minimal(frame(swapped, crossed, c, c), frame(a, b, h)).collect()
    ]
    assert sorted(reasons) == [(("w",), "duplicate"), (("y", "z"), "covered")]


def test_broken_structure(spark):
    catalog = local_frame(spark, [("f", "x"), ("d", "k")], "table_name string, column_name string")
    edges = rel.edge_frame(spark, [("f", ("x",), "d", ("k",)), ("f", ("y",), "d", ("k",)), ("g", ("x",), "d", ("k",))])
    got = {(r.edge, r.table_name, r.column_name) for r in rel.broken_structure(edges, catalog).collect()}
    assert got == {("f.y -> d.k", "f", "y"), ("g.x -> d.k", "g", None)}


def test_follow_in_two_roles(spark):
    fact = local_frame(spark, [(1, 2), (2, 2)], "a int, b int")
    dim = local_frame(spark, [(1, "one"), (2, "two")], "k int, n string")
    out = joins.follow(joins.follow(fact, dim, ("f", ("a",), "d", ("k",)), {"n": "na"}), dim, ("f", ("b",), "d", ("k",)), {"n": "nb"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "one", "two"), (2, 2, "two", "two")]


def test_subtotals_add_up(spark):
    fact = local_frame(spark, [(1, Decimal("1.0000")), (1, Decimal("2.0000")), (2, Decimal("4.0000"))], "k int, m decimal(19,4)")
    per_key = joins.subtotals(fact, ["k"], F.col("m")).withColumn("g", F.lit("x"))
    assert [tuple(r) for r in joins.totals(per_key, ["g"]).collect()] == [("x", 3, Decimal("7.0000"))]
