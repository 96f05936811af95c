"""The copy into a relational store: its statements, their order, and what a failure leaves."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from lakeproof.session import local_frame
from lakeproof.sources import lake

SCHEMA = T.StructType(
    [
        T.StructField("order_key", T.LongType(), False),
        T.StructField("total_price", T.DecimalType(19, 4)),
        T.StructField("order date", T.DateType()),
        T.StructField("note", T.StringType()),
    ]
)


class Recorded:
    """A store that keeps tables in memory and fails where it is told to."""

    def __init__(self, fail: str | None = None, lost: int = 0):
        self.steps, self.tables, self.fail, self.lost = [], {'"sales"."orders"': "old"}, fail, lost

    def execute(self, statements):
        self.steps.append(statements)
        before = dict(self.tables)
        for sql in statements:
            if self.fail and sql.startswith(self.fail):
                self.tables = before
                raise ConnectionError(sql)
            words = sql.split(" ")
            if sql.startswith("CREATE TABLE"):
                self.tables[words[2]] = 0
            elif sql.startswith("DROP TABLE"):
                self.tables.pop(words[4], None)
            elif " RENAME TO " in sql:
                self.tables[words[2].rsplit(".", 1)[0] + "." + words[-1]] = self.tables.pop(words[2])

    def append(self, df, table, options):
        if self.fail == "append":
            raise ConnectionError("append")
        assert df.select(lake.COPY_ROW).distinct().count() == df.count()
        self.tables[table] += df.count() - self.lost

    def number(self, sql):
        return self.tables[sql.split(" ")[-1]]


def rows(spark):
    return local_frame(spark, [(i, None, None, "x") for i in range(50)], SCHEMA)


def test_statements():
    steps = lake.relational_copy(SCHEMA, "sales.orders", {"user": "u"})
    assert steps.prepare == (
        'DROP TABLE IF EXISTS "sales"."orders__staging"',
        'CREATE TABLE "sales"."orders__staging" ("order_key" bigint NOT NULL, "total_price" numeric(19,4), "order date" date, "note" text, "_copy_row" bigint PRIMARY KEY)',
    )
    assert steps.publish == (
        'ALTER TABLE "sales"."orders__staging" DROP COLUMN "_copy_row"',
        'DROP TABLE IF EXISTS "sales"."orders"',
        'ALTER TABLE "sales"."orders__staging" RENAME TO "orders"',
    )
    assert steps.options == {"batchsize": "50000", "numPartitions": "16", "user": "u"}
    assert steps.count == 'SELECT count(*) FROM "sales"."orders__staging"'


def test_a_copy_takes_the_place_of_the_target(spark):
    store = Recorded()
    steps = lake.relational_copy(SCHEMA, "sales.orders")
    assert lake.copy_relational(rows(spark), store, "sales.orders") == 50
    assert store.tables == {'"sales"."orders"': 50}
    assert store.steps == [steps.prepare, steps.publish]
    assert lake.copy_relational(rows(spark), store, "sales.orders") == 50
    assert store.tables == {'"sales"."orders"': 50}


@pytest.mark.parametrize("store", [Recorded("append"), Recorded("ALTER TABLE"), Recorded(lost=3)], ids=["append", "publish", "lost rows"])
def test_a_failed_copy_leaves_the_target(spark, store):
    with pytest.raises((ConnectionError, RuntimeError)):
        lake.copy_relational(rows(spark), store, "sales.orders")
    assert store.tables == {'"sales"."orders"': "old"}


def test_a_failed_table_does_not_stop_the_others(spark):
    log = lake.copy_all({"sales.orders": rows(spark), "sales._copy_row": rows(spark).withColumnRenamed("note", "_copy_row")}, Recorded())
    got = {r.table_name: (r.rows, r.error) for r in log.collect()}
    assert got["sales.orders"] == (50, None)
    assert "may not be called" in got["sales._copy_row"][1]
