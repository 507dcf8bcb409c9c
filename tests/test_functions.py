"""Column builders one at a time, including the cases the reference never tests."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from verity.functions import (
    any_missing, amount_in_range, clean_name, date_in_range, impute, parse_amount, parse_date,
    parse_timestamp, partition_columns, standardize_column_names,
)


def one(spark, values, col_expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col_expr).collect()]


def test_clean_name():
    assert clean_name(" Transaction ID ") == "transaction_id"
    assert clean_name("Customer-Id") == "customer_id"
    assert clean_name("Amount($)") == "amount($)"


def test_standardize_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["Customer ID", "customer-id"])
    with pytest.raises(ValueError):
        standardize_column_names(df)


def test_parse_amount(spark):
    got = one(spark, ["100.00", "$1,204.50", "1,204.50", "", "N/A", "0.00", "-45.00",
                      "99999999999.00", "1.005", " 7 ", None], parse_amount("x"))
    assert got == [Decimal("100.00"), Decimal("1204.50"), Decimal("1204.50"), None, None,
                   Decimal("0.00"), Decimal("-45.00"), None, Decimal("1.01"), Decimal("7.00"), None]


def test_parse_date_layouts(spark):
    got = one(spark, ["2025-01-15", "01/15/2025", "2019-13-40", "1/5/2025", "not-a-date",
                      "2031-01-01", None], parse_date("x"))
    assert got == [dt.date(2025, 1, 15), dt.date(2025, 1, 15), None, None, None,
                   dt.date(2031, 1, 1), None]


def test_parse_timestamp(spark):
    got = one(spark, ["2025-01-15 10:00:00", "garbage", None], parse_timestamp("x"))
    assert got[0] == dt.datetime(2025, 1, 15, 10, 0) and got[1:] == [None, None]


def test_missing_and_impute(spark):
    df = spark.createDataFrame([("a",), ("",), ("   ",), (None,), ("NONE",)], "x string")
    v, flag = impute("x", "NONE")
    rows = df.select(v.alias("v"), flag.alias("f"), any_missing(["x"]).alias("m")).collect()
    assert [tuple(r) for r in rows] == [("a", False, False), ("NONE", True, True),
                                         ("NONE", True, True), ("NONE", True, True),
                                         ("NONE", False, False)]


def test_amount_range_and_date_bounds(spark):
    df = spark.createDataFrame([(Decimal("10.00"),), (Decimal("0.00"),), (Decimal("300.00"),),
                                (Decimal("300.01"),), (None,)], "x decimal(10,2)")
    got = [r[0] for r in df.select(amount_in_range("x", Decimal("300.00"))).collect()]
    assert got == [True, False, True, False, False]
    d = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 12, 31),),
                               (dt.date(2026, 12, 31),), (dt.date(2027, 1, 1),), (None,)], "x date")
    got = [r[0] for r in d.select(date_in_range("x", "2024-01-01", "2026-12-31")).collect()]
    assert got == [True, False, True, False, False]


def test_partition_columns(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 7),)], "d date")
    assert tuple(df.select(*partition_columns("d")).first()) == ("2025", "03", "07")
