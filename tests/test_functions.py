from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from lakeproof.functions import casting, digest, text, typing
from lakeproof.session import local_frame


@pytest.mark.parametrize("kind,precision,scale,stored", typing.GOLDEN_TYPES)
def test_loader_mapping(kind, precision, scale, stored):
    assert typing.spark_type(kind, precision, scale).simpleString() == stored


def test_restated_mapping(spark):
    rows = local_frame(spark, list(typing.GOLDEN_TYPES), "k string, p int, s int, stored string")
    got = rows.select("stored", typing.expected_type(F.col("k"), F.col("p"), F.col("s")).alias("got")).collect()
    assert len(got) == 23 and all(r.stored == r.got for r in got)


@pytest.mark.parametrize(
    "stored,copied",
    [
        (T.BooleanType(), "boolean"),
        (T.IntegerType(), "integer"),
        (T.LongType(), "bigint"),
        (T.FloatType(), "real"),
        (T.DoubleType(), "double precision"),
        (T.DecimalType(19, 4), "numeric(19,4)"),
        (T.DateType(), "date"),
        (T.TimestampNTZType(), "timestamp"),
        (T.TimestampType(), "timestamptz"),
        (T.TimeType(6), "time"),
        (T.BinaryType(), "bytea"),
        (T.StringType(), "text"),
    ],
)
def test_copy_types(stored, copied):
    assert typing.copy_type(stored) == copied


def cast_one(spark, value, to):
    df = local_frame(spark, [(value,)], "v string")
    return df.selectExpr(f"{casting.strict_cast('v', to, 't.v')} AS v").first().v


MONEY = T.DecimalType(19, 4)


@pytest.mark.parametrize(
    "value,to,want",
    [
        (None, T.IntegerType(), None),
        ("12", T.IntegerType(), 12),
        ("1", T.BooleanType(), True),
        ("0", T.BooleanType(), False),
        ("12.3456", MONEY, Decimal("12.3456")),
        ("12.34560000", MONEY, Decimal("12.3456")),
        ("-7", MONEY, Decimal("-7.0000")),
        ("1.5E2", MONEY, Decimal("150.0000")),
        ("123456789012345678901234567890", T.DecimalType(38, 0), Decimal("123456789012345678901234567890")),
    ],
)
def test_strict_cast_accepts(spark, value, to, want):
    assert cast_one(spark, value, to) == want


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "value,to",
    [
        ("x", T.IntegerType()),
        ("NA", T.IntegerType()),
        ("12.0", T.IntegerType()),
        ("99999999999", T.IntegerType()),
        ("12.34565", MONEY),
        ("1E-7", MONEY),
        ("1.5E-7", MONEY),
        ("1234567890123456", MONEY),
        ("2024", T.DateType()),
        ("2024-1-1", T.DateType()),
        ("2024-13-01", T.DateType()),
        ("2024-01-01", T.TimestampNTZType()),
        ("maybe", T.BooleanType()),
    ],
)
def test_strict_cast_refuses(spark, value, to, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException) as err:
            cast_one(spark, value, to)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert err.value.getCondition() == "USER_RAISED_EXCEPTION"
    assert f"t.v: not a {to.simpleString()}: {value}" in str(err.value)


def test_timestamps_keep_microseconds(spark):
    got = cast_one(spark, "2024-01-01 10:00:00.123456000", T.TimestampNTZType())
    assert got.microsecond == 123456
    with pytest.raises(PySparkException, match="not a timestamp_ntz"):
        cast_one(spark, "2024-01-01 10:00:00.123456789", T.TimestampNTZType())


GUARDED = [
    T.BooleanType(),
    T.IntegerType(),
    T.LongType(),
    T.FloatType(),
    T.DoubleType(),
    MONEY,
    T.DecimalType(38, 0),
    T.DateType(),
    T.TimestampNTZType(),
    T.TimestampType(),
    T.StringType(),
]


@pytest.mark.parametrize("of", GUARDED, ids=lambda t: t.simpleString())
def test_guard_makes_required_and_rejects_null(spark, of):
    sample = {"boolean": "true", "date": "2024-01-01"}.get(of.simpleString(), "1")
    if "timestamp" in of.simpleString():
        sample = "2024-01-01 00:00:00"
    value = f"{casting.not_null(f'CAST(v AS {of.simpleString()})', of, 't.v')} AS v"
    clean = local_frame(spark, [(sample,)], "v string").selectExpr(value)
    assert not clean.schema["v"].nullable
    assert len(clean.collect()) == 1
    with pytest.raises(PySparkException) as err:
        local_frame(spark, [(sample,), (None,)], "v string").selectExpr(value).collect()
    assert "t.v: NULL in a NOT NULL column" in str(err.value)


@pytest.mark.parametrize(
    "source,name",
    [
        ("DimCustomer", "dim_customer"),
        ("FactInternetSales", "fact_internet_sales"),
        ("CustomerPONumber", "customer_po_number"),
        ("UnitPriceDiscountPct", "unit_price_discount_pct"),
        ("SalesDWBuildVersion", "sales_dw_build_version"),
        ("AddressLine1", "address_line1"),
    ],
)
def test_snake_case(spark, source, name):
    assert local_frame(spark, [(source,)], "n string").select(text.snake_case(F.col("n"))).first()[0] == name


def test_nul_and_empties(spark):
    df = local_frame(spark, [("a\x00b",), ("\x00",), ("",), (None,), ("NA",)], "v string")
    got = [tuple(r) for r in df.selectExpr(text.strip_nul("v"), text.empty_to_null("v")).collect()]
    assert got == [("ab", "a\x00b"), ("", "\x00"), ("", None), (None, None), ("NA", "NA")]


@pytest.mark.parametrize(
    "value,want",
    [("12", "12.00"), ("12.345", "12.35"), ("1e2", "100.00"), ("Red", "Red"), ("", ""), (None, None), ("-0.001", "0.00")],
)
def test_comparable(spark, value, want):
    assert local_frame(spark, [(value,)], "v string").select(text.comparable(F.col("v"))).first()[0] == want


def test_stringified_keeps_plain_types(spark):
    df = spark.sql("SELECT 1 AS i, 2.5D AS d, true AS b, 'x' AS s, 1.50BD AS m, DATE '2024-01-02' AS t")
    out = text.stringified(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "double", "boolean", "string", "string", "string"]
    assert tuple(out.first())[4:] == ("1.50", "2024-01-02")


def digest_of(df, column="v", portable=False):
    of = df.schema[column].dataType
    return df.selectExpr(f"{digest.digest(*digest.digest_parts(digest.value_hash(column, of, portable)))} AS d").first().d


@pytest.mark.parametrize("portable", [True, False])
def test_digest_is_a_multiset(spark, portable):
    a = local_frame(spark, [(1,), (2,), (2,), (None,)], "v bigint")
    b = local_frame(spark, [(2,), (None,), (1,), (2,)], "v bigint")
    c = local_frame(spark, [(1,), (1,), (2,), (None,)], "v bigint")
    assert digest_of(a, portable=portable) == digest_of(b, portable=portable) != digest_of(c, portable=portable)


def test_digest_is_the_exact_sum_of_the_hashes(spark):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS v")
    hashes = [r[0] & ((1 << 64) - 1) for r in df.selectExpr("xxhash64(v)").collect()]
    assert int(digest_of(df)) == sum(hashes)


def test_digest_does_not_confuse_minus_one_and_minus_two(spark):
    assert digest_of(local_frame(spark, [(-1,)], "v int")) != digest_of(local_frame(spark, [(-2,)], "v int"))


def test_digest_of_nothing_is_zero(spark):
    assert digest_of(local_frame(spark, [(None,)], "v int")) == 0
    assert digest_of(local_frame(spark, [], "v int")) == 0


def test_zero_and_negative_zero_are_one_value(spark):
    assert digest_of(spark.sql("SELECT 0D AS v")) == digest_of(spark.sql("SELECT -0D AS v"))
