"""Queries: keys, referential checks, hierarchies, joins along edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.operators import hierarchy, joins, keys
from lakeproof.operators.keys import Edge, spell_edge
from lakeproof.operators.profile import union_all
from lakeproof.operators.reconcile import first_per_group
from lakeproof.plans import planted, star
from lakeproof.plans.registry import over, query, rows_sql, values_sql
from lakeproof.session import local_frame

ALL_EDGES = star.DECLARED + star.UNDECLARED + star.CURATED


def _tables(edges: tuple[Edge, ...]) -> list[str]:
    return list(dict.fromkeys(t for child, _, parent, _ in edges for t in (child, parent)))


def edge_sql(edge: Edge, child: str | None = None, parent: str | None = None) -> str:
    """The audit of one edge, by plain subqueries over the child's distinct keys."""
    c, fk, p, pk = edge
    child, parent = child or c, parent or p
    whole = " AND ".join(f"{f} IS NOT NULL" for f in fk)
    match = " AND ".join(f"t.{b} = k.{a}" for a, b in zip(fk, pk))
    cols = ", ".join(fk)
    orphans = (
        f"(SELECT {cols}, count(*) AS refs FROM {child} k WHERE {whole} AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} t WHERE {match}) GROUP BY {cols})"
    )
    distinct_targets = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(pk)} FROM {parent}))"
    return (
        f"SELECT '{spell_edge(edge)}' AS edge, (SELECT count(*) FROM {child} WHERE {whole}) AS compared, "
        f"(SELECT count(*) FROM {orphans}) AS orphan_keys, "
        f"CAST((SELECT coalesce(sum(refs), 0) FROM {orphans}) AS BIGINT) AS orphan_rows, "
        f"(SELECT count(*) FROM {parent}) - {distinct_targets} AS target_surplus"
    )


def key_sql(table: str, key: tuple[str, ...]) -> str:
    cols = ", ".join(key)
    missing = " OR ".join(f"{k} IS NULL" for k in key)
    return (
        f"SELECT '{table}' AS table_name, '{'+'.join(key)}' AS key_name, count(*) AS rows, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table})) AS surplus, "
        f"count(*) FILTER ({missing}) AS null_rows FROM {table}"
    )


@query("key_uniqueness", over(*star.TABLES, body=rows_sql([key_sql(t, k) for t, k in star.CANDIDATE_KEYS.items()])))
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen candidate keys; the line items' is not one."""
    return keys.key_audit(star.frames(spark, sf_dir), list(star.CANDIDATE_KEYS.items()))


@query(
    "duplicate_examples",
    over(
        "fact_lineitem",
        body="SELECT order_key, line_number, count(*) AS rows FROM fact_lineitem GROUP BY order_key, line_number "
        "HAVING count(*) > 1 ORDER BY order_key, line_number LIMIT 3",
    ),
)
def duplicate_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three repeated keys, which is all a finding shows."""
    return keys.duplicate_examples(star.frame(spark, sf_dir, "fact_lineitem"), ["order_key", "line_number"])


def stray_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star with orders whose customers do not exist or are missing."""
    frames = star.frames(spark, sf_dir)
    frames["dim_order"] = planted.plant(frames["dim_order"], planted.STRAY_CUSTOMERS)
    return frames


_STRAY = {"stray": planted.plant_sql("dim_order", planted.STRAY_CUSTOMERS)}


def _stray_sql(edge: Edge) -> str:
    return edge_sql(edge, *("stray" if t == "dim_order" else None for t in (edge[0], edge[2])))


@query(
    "fk_orphans",
    over(
        *_tables(ALL_EDGES),
        also=_STRAY,
        body=f"SELECT edge, compared, orphan_keys, orphan_rows FROM ({rows_sql([_stray_sql(e) for e in ALL_EDGES])})",
    ),
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All thirteen edges at once, with planted stray and missing customers."""
    return keys.edge_audit(stray_frames(spark, sf_dir), ALL_EDGES).drop("target_surplus")


@query(
    "edge_coverage",
    over(
        *_tables(ALL_EDGES),
        also={"unused": planted.plant_sql("fact_event", planted.NO_USERS)},
        body="SELECT edge, compared, compared = 0 AS vacuous FROM ("
        + rows_sql([edge_sql(e, "unused" if e[0] == "fact_event" else None) for e in ALL_EDGES])
        + ")",
    ),
)
def edge_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each edge tested; the events have lost their users and test nothing."""
    frames = star.frames(spark, sf_dir)
    frames["fact_event"] = planted.plant(frames["fact_event"], planted.NO_USERS)
    audit = keys.edge_audit(frames, ALL_EDGES)
    return audit.select("edge", "compared", (F.col("compared") == 0).alias("vacuous"))


_REPLY: Edge = star.DECLARED[10]


@query(
    "fk_orphans_composite",
    over(
        "fact_conversation",
        body="SELECT c.conversation_id, c.prior_turn_number, count(*) AS refs FROM fact_conversation c "
        "WHERE c.prior_turn_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fact_conversation p WHERE p.role_name <> 'assistant' "
        "AND p.conversation_id = c.conversation_id AND p.turn_number = c.prior_turn_number) "
        "GROUP BY c.conversation_id, c.prior_turn_number",
    ),
)
def fk_orphans_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose previous turn is gone once the assistant's turns are."""
    turns = star.frame(spark, sf_dir, "fact_conversation")
    frames = {"fact_conversation": turns, "kept": turns.where("role_name <> 'assistant'")}
    orphans = keys.orphan_keys(frames, (_REPLY[0], _REPLY[1], "kept", _REPLY[3]))
    return orphans.select(F.col("k0").alias("conversation_id"), F.col("k1").alias("prior_turn_number"), "refs")


_USER_NAME = "concat('Customer#', lpad(CAST(user_id AS {}), 9, '0'))"
_NATURAL: Edge = ("fact_event", ("customer_name",), "dim_customer", ("customer_alternate_key",))


@query(
    "fk_orphans_natural",
    over(
        "fact_event",
        "dim_customer",
        also={
            "named": "SELECT CASE WHEN event_type = 'error' THEN 'Customer#?' || event_id ELSE "
            f"{_USER_NAME.format('VARCHAR')} END AS customer_name FROM fact_event"
        },
        body=edge_sql(_NATURAL, "named"),
    ),
)
def fk_orphans_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events against customers by name, not by surrogate key; errors name nobody."""
    frames = star.frames(spark, sf_dir, ("fact_event", "dim_customer"))
    frames["fact_event"] = frames["fact_event"].selectExpr(
        "CASE WHEN event_type = 'error' THEN concat('Customer#?', event_id) ELSE "
        f"{_USER_NAME.format('STRING')} END AS customer_name"
    )
    return keys.edge_audit(frames, [_NATURAL])


# Edges read backwards or with a part of the key missing: their targets repeat.
_BACKWARDS: tuple[Edge, ...] = (
    ("dim_order", ("order_key",), "fact_lineitem", ("order_key",)),
    ("dim_customer", ("customer_key",), "dim_order", ("customer_key",)),
    ("fact_conversation", ("conversation_id",), "fact_conversation", ("conversation_id",)),
    ("fact_lineitem", ("part_key",), "dim_part", ("part_key",)),
)


@query(
    "fk_target_unique",
    over(
        *_tables(_BACKWARDS),
        body=f"SELECT edge, target_surplus FROM ({rows_sql([edge_sql(e) for e in _BACKWARDS])})",
    ),
)
def fk_target_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = star.frames(spark, sf_dir, _tables(_BACKWARDS))
    return keys.edge_audit(frames, _BACKWARDS).select("edge", "target_surplus")


@query(
    "join_fanout",
    over(
        *_tables(_BACKWARDS + star.DECLARED),
        body=rows_sql(
            [
                f"SELECT '{spell_edge(e)}' AS edge, (SELECT count(*) FROM {e[0]}) AS rows_before, "
                f"(SELECT count(*) FROM {e[0]} a JOIN {e[2]} b ON "
                + " AND ".join(f"a.{x} = b.{y}" for x, y in zip(e[1], e[3]))
                + ") AS rows_after"
                for e in star.DECLARED + _BACKWARDS[:2]
            ]
        ),
    ),
)
def join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows before and after each join; only the backward edges grow."""
    edges = star.DECLARED + _BACKWARDS[:2]
    return keys.join_fanout(star.frames(spark, sf_dir, _tables(edges)), edges)


_E = {f"{e[0]}.{e[1][0]}": e for e in ALL_EDGES}


@query(
    "role_playing_join",
    over(
        "fact_lineitem", "dim_order", "dim_customer", "dim_supplier", "dim_nation",
        body="SELECT cn.nation_name AS customer_nation, sn.nation_name AS supplier_nation, count(*) AS n, "
        "CAST(sum(extended_price) AS DECIMAL(38,4)) AS total FROM fact_lineitem l "
        "JOIN dim_order o ON l.order_key = o.order_key JOIN dim_customer c ON o.customer_key = c.customer_key "
        "JOIN dim_supplier s ON l.supplier_key = s.supplier_key JOIN dim_nation cn ON c.nation_key = cn.nation_key "
        "JOIN dim_nation sn ON s.nation_key = sn.nation_key GROUP BY 1, 2 ORDER BY 1, 2",
    ),
)
def role_playing_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation dimension in two roles: the customer's and the supplier's.

    The fact is shuffled once, by order, and only after orders know their
    customer's nation; then there is one row for each supplier and nation.
    Names are joined to the few totals.
    """
    d = star.frames(spark, sf_dir, ("fact_lineitem", "dim_order", "dim_customer", "dim_supplier", "dim_nation"))
    orders = joins.follow(
        d["dim_order"], d["dim_customer"], _E["dim_order.customer_key"], {"nation_key": "customer_nation_key"}
    )
    lines = joins.follow(d["fact_lineitem"], orders, _E["fact_lineitem.order_key"], {"customer_nation_key": "customer_nation_key"})
    per_supplier = joins.subtotals(lines, ["supplier_key", "customer_nation_key"], F.col("extended_price"))
    joined = joins.follow(per_supplier, d["dim_supplier"], _E["fact_lineitem.supplier_key"], {"nation_key": "supplier_nation_key"})
    named = joins.combined(joined, ["customer_nation_key", "supplier_nation_key"])
    for role in ("customer", "supplier"):
        edge = ("totals", (f"{role}_nation_key",), "dim_nation", ("nation_key",))
        named = joins.follow(named, d["dim_nation"], edge, {"nation_name": f"{role}_nation"})
    return joins.totals(named, ["customer_nation", "supplier_nation"])


@query(
    "star_join",
    over(
        "fact_lineitem", "dim_order", "dim_customer", "dim_nation", "dim_region", "dim_date",
        body="SELECT region_name, calendar_year, count(*) AS n, CAST(sum(extended_price) AS DECIMAL(38,4)) AS total "
        "FROM fact_lineitem l JOIN dim_order o ON l.order_key = o.order_key "
        "JOIN dim_customer c ON o.customer_key = c.customer_key JOIN dim_nation n ON c.nation_key = n.nation_key "
        "JOIN dim_region r ON n.region_key = r.region_key JOIN dim_date d ON l.ship_date_key = d.date_key "
        "GROUP BY 1, 2 ORDER BY 1, 2",
    ),
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by customer region and ship year along the checked edges.

    The large join carries keys; region names are joined to the totals per nation.
    """
    d = star.frames(spark, sf_dir, ("fact_lineitem", "dim_order", "dim_customer", "dim_nation", "dim_region", "dim_date"))
    lines = joins.follow(
        d["fact_lineitem"], d["dim_date"], _E["fact_lineitem.ship_date_key"], {"calendar_year": "calendar_year"}
    )
    per_order = joins.subtotals(lines, ["order_key", "calendar_year"], F.col("extended_price"))
    orders = joins.follow(d["dim_order"], d["dim_customer"], _E["dim_order.customer_key"], {"nation_key": "nation_key"})
    joined = joins.follow(per_order, orders, _E["fact_lineitem.order_key"], {"nation_key": "nation_key"})
    per_nation = joins.combined(joined, ["nation_key", "calendar_year"])
    regions = joins.follow(per_nation, d["dim_nation"], _E["dim_customer.nation_key"], {"region_key": "region_key"})
    named = joins.follow(regions, d["dim_region"], _E["dim_nation.region_key"], {"region_name": "region_name"})
    return joins.totals(named, ["region_name", "calendar_year"])


@query(
    "dangling_parents",
    over(
        "dim_customer",
        also={"p": planted.plant_sql("dim_customer", planted.DANGLING)},
        body="SELECT parent_customer_key AS parent, count(*) AS children FROM p WHERE parent_customer_key IS NOT NULL "
        "AND parent_customer_key NOT IN (SELECT customer_key FROM p) GROUP BY parent_customer_key",
    ),
)
def dangling_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = planted.plant(star.frame(spark, sf_dir, "dim_customer"), planted.DANGLING)
    return hierarchy.dangling_parents(customers, "customer_key", "parent_customer_key")


@query(
    "conflicting_parents",
    over(
        "fact_conversation",
        body="SELECT conversation_id AS node, min(prior_turn_number) AS low, max(prior_turn_number) AS high "
        "FROM fact_conversation GROUP BY conversation_id "
        "HAVING min(prior_turn_number) <> max(prior_turn_number) OR "
        "(count(prior_turn_number) > 0 AND count(prior_turn_number) < count(*))",
    ),
)
def conflicting_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations taken for nodes: every longer one names several parents."""
    turns = star.frame(spark, sf_dir, "fact_conversation")
    return hierarchy.conflicting_parents(turns, "conversation_id", "prior_turn_number")


@query(
    "hierarchy_cycles",
    "WITH RECURSIVE dim_customer AS ("
    + star.STAR_SQL["dim_customer"]
    + "), p AS ("
    + planted.plant_sql("dim_customer", planted.CYCLES)
    + "), edge AS (SELECT customer_key AS node, parent_customer_key AS hop FROM p WHERE parent_customer_key IS NOT NULL UNION SELECT * FROM "
    + values_sql("node, hop", list(planted.SECOND_PARENTS))
    + "), reach AS (SELECT node, hop FROM edge UNION SELECT r.node, edge.hop FROM reach r JOIN edge ON r.hop = edge.node) "
    # Whoever reaches a node that reaches itself.
    "SELECT DISTINCT node FROM reach WHERE hop IN (SELECT node FROM reach WHERE node = hop)",
)
def hierarchy_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer whose parents lead into the planted cycles, some through the smaller of two parents."""
    customers = planted.plant(star.frame(spark, sf_dir, "dim_customer"), planted.CYCLES)
    second = local_frame(spark, list(planted.SECOND_PARENTS), "customer_key bigint, parent_customer_key bigint")
    edges = customers.select("customer_key", "parent_customer_key").unionAll(second)
    return hierarchy.cycle_starts(edges, "customer_key", "parent_customer_key")


_CAPPED: tuple[Edge, ...] = (
    star.DECLARED[4],
    ("fact_event", ("event_id",), "dim_customer", ("customer_key",)),
)


@query(
    "capped_findings",
    over(
        "dim_order", "dim_customer", "fact_event",
        also=_STRAY
        | {
            "orphans": "SELECT 'dim_order' AS child, customer_key AS key, count(*) AS refs FROM stray WHERE customer_key NOT IN "
            "(SELECT customer_key FROM dim_customer) GROUP BY customer_key UNION ALL "
            "SELECT 'fact_event', event_id, count(*) FROM fact_event WHERE event_id NOT IN "
            "(SELECT customer_key FROM dim_customer) GROUP BY event_id"
        },
        body="SELECT child, key, refs FROM orphans QUALIFY row_number() OVER (PARTITION BY child ORDER BY key) <= 3",
    ),
)
def capped_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three example orphans per edge; the counts elsewhere are never capped."""
    frames = stray_frames(spark, sf_dir)
    found = union_all(
        keys.orphan_keys(frames, e).select(F.lit(e[0]).alias("child"), F.col("k0").alias("key"), "refs") for e in _CAPPED
    )
    return first_per_group(found, ["child"], ["key"], 3)
