"""A star schema laid over the fourteen test tables.

The checks work on names like ``dim_customer.nation_key``, on pinned types and
on declared edges. This module gives the test tables such names and types: the
frames are lazy projections of the parquet files, the specs pin their columns,
and ``STAR_SQL`` states the same projections in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeproof.operators.keys import Edge
from lakeproof.sources.specs import PinnedColumn, TableSpec, projection

PHYSICAL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table under its known schema; nothing is inferred."""
    return spark.read.schema(PHYSICAL[table]).parquet(f"{sf_dir}/{table}.parquet")


# table -> source table name, multi-line text, columns as "Name type[!]"; ! is NOT NULL.
_PINNED = {
    "dim_region": ("DimRegion", False, "RegionKey int!, RegionName nvarchar!"),
    "dim_nation": ("DimNation", False, "NationKey int!, NationName nvarchar!, RegionKey int!"),
    "dim_customer": (
        "DimCustomer",
        False,
        "CustomerKey bigint!, ParentCustomerKey bigint, CustomerAlternateKey nvarchar!, NationKey int!, "
        "AccountBalance money, MarketSegment nvarchar",
    ),
    "dim_supplier": (
        "DimSupplier",
        False,
        "SupplierKey bigint!, SupplierAlternateKey nvarchar!, NationKey int!, AccountBalance money",
    ),
    "dim_part": (
        "DimPart",
        False,
        "PartKey bigint!, PartName nvarchar!, BrandName nvarchar, PartType nvarchar, PartSize smallint, RetailPrice money",
    ),
    "dim_date": (
        "DimDate",
        False,
        "DateKey int!, FullDateAlternateKey date!, CalendarYear smallint!, CalendarQuarter tinyint!",
    ),
    "dim_order": (
        "DimOrder",
        False,
        "OrderKey bigint!, CustomerKey bigint!, OrderDateKey int!, OrderStatus nchar!, TotalPrice money!, "
        "OrderDate datetime, OrderPriority nvarchar",
    ),
    "fact_lineitem": (
        "FactLineitem",
        False,
        "OrderKey bigint!, PartKey bigint!, SupplierKey bigint!, LineNumber tinyint!, ShipDateKey int!, Quantity float!, "
        "ExtendedPrice money!, DiscountPct float!, TaxPct float!, ReturnFlag nchar, LineStatus nchar, ShipDate datetime",
    ),
    "fact_event": (
        "FactEvent",
        False,
        "EventId bigint!, EventTime datetime!, UserId bigint, EventType nvarchar!, EventValue float, EventProps nvarchar",
    ),
    "dim_document": (
        "DimDocument",
        True,
        "DocumentKey bigint!, DocumentText nvarchar, LanguageCode nchar!, SourceName nvarchar, CharCount bigint!",
    ),
    "fact_document_label": ("FactDocumentLabel", False, "DocumentKey bigint!, QualityScore int!, ToxicFlag bit!"),
    "fact_conversation": (
        "FactConversation",
        True,
        "ConversationId bigint!, TurnNumber bigint!, PriorTurnNumber bigint, RoleName nvarchar!, MessageText nvarchar",
    ),
    "fact_embedding": ("FactEmbedding", False, "VectorId bigint!, EmbeddingValues varbinary, LabelId int"),
    "fact_page": ("FactPage", True, "PageId bigint!, PageUrl nvarchar!, PageHtml nvarchar"),
    "fact_benchmark_item": ("FactBenchmarkItem", True, "ItemId bigint!, ItemText nvarchar!"),
}


def _snake(pascal: str) -> str:
    return "".join(f"_{ch.lower()}" if ch.isupper() else ch for ch in pascal).lstrip("_")


def _spec(table: str) -> TableSpec:
    source, multi_line, listing = _PINNED[table]
    columns = []
    for item in listing.split(", "):
        name, sql_type = item.split(" ")
        columns.append(
            PinnedColumn(name, _snake(name), sql_type.rstrip("!"), nullable=not sql_type.endswith("!"))
        )
    return TableSpec(f"dbo.{source}", table, tuple(columns), multi_line)


SPECS: dict[str, TableSpec] = {t: _spec(t) for t in _PINNED}
TABLES = tuple(SPECS)

def _date_key(ts: str) -> str:
    return f"year({ts}) * 10000 + month({ts}) * 100 + day({ts})"


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order and ship date once; combined before the shuffle."""
    ordered = base(spark, sf_dir, "orders").selectExpr("CAST(o_orderdate AS DATE) AS d")
    shipped = base(spark, sf_dir, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS d")
    return ordered.unionAll(shipped).distinct().selectExpr(
        f"{_date_key('d')} AS date_key",
        "d AS full_date_alternate_key",
        "year(d) AS calendar_year",
        "quarter(d) AS calendar_quarter",
    )


def frame(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One star table; column order and types are those of its spec."""
    if table == "dim_date":
        return _dates(spark, sf_dir)
    origin, values = _PROJECTIONS[table]
    spec = SPECS[table]
    cells = {
        c.name: f"CAST({value} AS {c.stored.simpleString()})" if c in spec.kept else value
        for c, value in zip(spec.columns, values)
    }
    return base(spark, sf_dir, origin).selectExpr(*projection(cells))


def frames(spark: SparkSession, sf_dir: str, tables=TABLES) -> dict[str, DataFrame]:
    return {t: frame(spark, sf_dir, t) for t in tables}


_PROJECTIONS = {
    "dim_region": ("region", ["r_regionkey", "r_name"]),
    "dim_nation": ("nation", ["n_nationkey", "n_name", "n_regionkey"]),
    "dim_customer": (
        "customer",
        ["c_custkey", "if(c_custkey > 0, c_custkey div 10, null)", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    ),
    "dim_supplier": ("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]),
    "dim_part": ("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
    "dim_order": (
        "orders",
        [
            "o_orderkey",
            "o_custkey",
            _date_key("o_orderdate"),
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            "o_orderpriority",
        ],
    ),
    "fact_lineitem": (
        "lineitem",
        [
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            _date_key("l_shipdate"),
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
            "l_shipdate",
        ],
    ),
    "fact_event": ("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
    "dim_document": ("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "fact_document_label": ("labels", ["doc_id", "quality", "toxic = 1"]),
    "fact_conversation": (
        "conversations",
        ["conv_id", "turn", "if(turn > 0, turn - 1, null)", "role", "text"],
    ),
    "fact_embedding": ("embeddings", ["vec_id", "embedding", "label"]),
    "fact_page": ("pages", ["page_id", "url", "html"]),
    "fact_benchmark_item": ("benchmark", ["item_id", "text"]),
}

# The same projections for the oracle.
STAR_SQL = {
    "dim_region": "SELECT r_regionkey AS region_key, r_name AS region_name FROM region",
    "dim_nation": "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation",
    "dim_customer": "SELECT c_custkey AS customer_key, CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS parent_customer_key, "
    "c_name AS customer_alternate_key, c_nationkey AS nation_key, CAST(c_acctbal AS DECIMAL(19,4)) AS account_balance, "
    "c_mktsegment AS market_segment FROM customer",
    "dim_supplier": "SELECT s_suppkey AS supplier_key, s_name AS supplier_alternate_key, s_nationkey AS nation_key, "
    "CAST(s_acctbal AS DECIMAL(19,4)) AS account_balance FROM supplier",
    "dim_part": "SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_name, p_type AS part_type, "
    "p_size AS part_size, CAST(p_retailprice AS DECIMAL(19,4)) AS retail_price FROM part",
    "dim_date": "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date_alternate_key, "
    "CAST(year(d) AS INTEGER) AS calendar_year, CAST(quarter(d) AS INTEGER) AS calendar_quarter FROM "
    "(SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)",
    "dim_order": "SELECT o_orderkey AS order_key, o_custkey AS customer_key, "
    "CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key, o_orderstatus AS order_status, "
    "CAST(o_totalprice AS DECIMAL(19,4)) AS total_price, o_orderdate AS order_date, o_orderpriority AS order_priority FROM orders",
    "fact_lineitem": "SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supplier_key, "
    "l_linenumber AS line_number, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key, l_quantity AS quantity, "
    "CAST(l_extendedprice AS DECIMAL(19,4)) AS extended_price, l_discount AS discount_pct, l_tax AS tax_pct, "
    "l_returnflag AS return_flag, l_linestatus AS line_status, l_shipdate AS ship_date FROM lineitem",
    "fact_event": "SELECT event_id, ts AS event_time, user_id, event_type, value AS event_value, props AS event_props FROM events",
    "dim_document": "SELECT doc_id AS document_key, text AS document_text, lang AS language_code, source AS source_name, "
    "n_chars AS char_count FROM documents",
    "fact_document_label": "SELECT doc_id AS document_key, quality AS quality_score, toxic = 1 AS toxic_flag FROM labels",
    "fact_conversation": "SELECT conv_id AS conversation_id, turn AS turn_number, CASE WHEN turn > 0 THEN turn - 1 END AS "
    "prior_turn_number, role AS role_name, text AS message_text FROM conversations",
    "fact_embedding": "SELECT vec_id AS vector_id, embedding AS embedding_values, label AS label_id FROM embeddings",
    "fact_page": "SELECT page_id, url AS page_url, html AS page_html FROM pages",
    "fact_benchmark_item": "SELECT item_id, text AS item_text FROM benchmark",
}

# The relationships the source declares: one self-reference, one composite.
DECLARED: tuple[Edge, ...] = (
    ("dim_nation", ("region_key",), "dim_region", ("region_key",)),
    ("dim_customer", ("nation_key",), "dim_nation", ("nation_key",)),
    ("dim_customer", ("parent_customer_key",), "dim_customer", ("customer_key",)),
    ("dim_supplier", ("nation_key",), "dim_nation", ("nation_key",)),
    ("dim_order", ("customer_key",), "dim_customer", ("customer_key",)),
    ("dim_order", ("order_date_key",), "dim_date", ("date_key",)),
    ("fact_lineitem", ("order_key",), "dim_order", ("order_key",)),
    ("fact_lineitem", ("part_key",), "dim_part", ("part_key",)),
    ("fact_lineitem", ("supplier_key",), "dim_supplier", ("supplier_key",)),
    ("fact_document_label", ("document_key",), "dim_document", ("document_key",)),
    ("fact_conversation", ("conversation_id", "prior_turn_number"), "fact_conversation", ("conversation_id", "turn_number")),
)
# In the names but not declared.
UNDECLARED: tuple[Edge, ...] = (("fact_lineitem", ("ship_date_key",), "dim_date", ("date_key",)),)
# In the data only: no declaration, and no name that says so.
CURATED: tuple[Edge, ...] = (("fact_event", ("user_id",), "dim_customer", ("customer_key",)),)
HIERARCHIES: tuple[Edge, ...] = (DECLARED[2],)

# Keys each table is expected to hold only once.
CANDIDATE_KEYS: dict[str, tuple[str, ...]] = {
    "dim_region": ("region_key",),
    "dim_nation": ("nation_key",),
    "dim_customer": ("customer_key",),
    "dim_supplier": ("supplier_key",),
    "dim_part": ("part_key",),
    "dim_date": ("date_key",),
    "dim_order": ("order_key",),
    "fact_lineitem": ("order_key", "line_number"),
    "fact_event": ("event_id",),
    "dim_document": ("document_key",),
    "fact_document_label": ("document_key",),
    "fact_conversation": ("conversation_id", "turn_number"),
    "fact_embedding": ("vector_id",),
    "fact_page": ("page_id",),
    "fact_benchmark_item": ("item_id",),
}
