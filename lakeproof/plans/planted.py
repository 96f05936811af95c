"""Defects planted on purpose, as SQL both engines understand.

Each entry replaces one column of a star table by an expression over that
table's own columns. The conditions are about values, and every row of the
table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Empty, 'NA' and 'null' segments.
SEGMENTS = {
    "market_segment": "CASE WHEN account_balance < 0 THEN '' WHEN account_balance BETWEEN 1000 AND 2000 THEN 'NA' "
    "WHEN account_balance BETWEEN 3000 AND 4000 THEN 'null' ELSE market_segment END"
}
# 'NA' lost to NULL, as a careless reader would do.
SEGMENTS_LOST = {
    "market_segment": "CASE WHEN account_balance < 0 THEN NULL WHEN account_balance BETWEEN 1000 AND 2000 THEN NULL "
    "WHEN account_balance BETWEEN 3000 AND 4000 THEN 'null' ELSE market_segment END"
}
# Names holding a NUL byte, being one, or missing.
NUL_NAMES = {
    "part_name": "CASE WHEN part_size = 7 THEN chr(0) WHEN part_size < 7 THEN concat(part_name, chr(0), 'x') "
    "WHEN part_size = 50 THEN NULL ELSE part_name END"
}
# Keys pointing nowhere, and missing keys.
STRAY_CUSTOMERS = {
    "customer_key": "CASE WHEN order_priority = '1-URGENT' THEN customer_key + 100000000000 "
    "WHEN order_priority = '5-LOW' THEN NULL ELSE customer_key END"
}
# A cent added here and there, dates a day late, priorities replaced.
WRONG_ORDERS = {
    "total_price": "CASE WHEN order_status = 'P' THEN CAST(total_price + 0.01 AS DECIMAL(19,4)) ELSE total_price END",
    "order_date": "order_date + INTERVAL 1 DAY",
    "order_priority": "'0-NONE'",
}
# A three-node cycle, a self-parent, and parents that do not exist.
CYCLES = {
    "parent_customer_key": "CASE customer_key WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 5 THEN 5 "
    "ELSE parent_customer_key END"
}
# Further parents of two customers: a cycle that the largest parent of each does not show.
SECOND_PARENTS = ((41, 60), (4, 41))
DANGLING = {
    "parent_customer_key": "CASE WHEN account_balance < 0 THEN -1 - nation_key ELSE parent_customer_key END"
}
NO_USERS = {"user_id": "CAST(NULL AS BIGINT)"}


def plant(df: DataFrame, defect: dict[str, str]) -> DataFrame:
    """The frame with the defect in it; column order and types stay."""
    return df.select(
        *[
            F.expr(defect[f.name]).cast(f.dataType).alias(f.name) if f.name in defect else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def plant_sql(table: str, defect: dict[str, str]) -> str:
    replaced = ", ".join(f"{expr} AS {column}" for column, expr in defect.items())
    return f"SELECT * REPLACE ({replaced}) FROM {table}"
