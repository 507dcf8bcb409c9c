"""A4-A11 kept up to date: per-day totals of the curated rows.

A rollup holds partial states (exact sums and counts) per day and entity, in
folders by day like the facts. A batch replaces the totals of the days it
replaced, from the rows it wrote, and no other day is read. The questions are
then answered by adding states up: a year of facts is as many rows as it has
(day, product) or (day, customer) pairs, and the facts are not scanned. Sums
are decimals and counts longs, so adding them up day by day changes nothing.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity import constants as K
from verity.plans import analytics as A
from verity.sinks.writers import write_partitioned

TOTAL = T.DecimalType(38, 2)


def _schema(key: str, *counts: str) -> T.StructType:
    fields = [T.StructField(key, T.StringType()), T.StructField("revenue", TOTAL)]
    fields += [T.StructField(c, T.LongType()) for c in counts]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in K.PARTITION_COLUMNS])


PRODUCTS = _schema("product_id", "transaction_count", "units_sold")
CUSTOMERS = _schema("customer_id", "transaction_count")


def daily_products(curated: DataFrame) -> DataFrame:
    return (curated.groupBy("product_id", *K.PARTITION_COLUMNS)
            .agg(F.sum("amount").cast(TOTAL).alias("revenue"), F.count(F.lit(1)).alias("transaction_count"),
                 F.sum("quantity").alias("units_sold")).select(*PRODUCTS.names))


def daily_customers(curated: DataFrame) -> DataFrame:
    return (curated.groupBy("customer_id", *K.PARTITION_COLUMNS)
            .agg(F.sum("amount").cast(TOTAL).alias("revenue"), F.count(F.lit(1)).alias("transaction_count"))
            .select(*CUSTOMERS.names))


# Table name: schema and the totals of some curated rows (whole days).
ROLLUPS: dict[str, tuple[T.StructType, Callable[[DataFrame], DataFrame]]] = {
    "daily_products": (PRODUCTS, daily_products),
    "daily_customers": (CUSTOMERS, daily_customers),
}


def rollup_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_rollups(days: DataFrame, root: str) -> None:
    """Replace the totals of the days in ``days`` (curated rows, each day whole)."""
    for name, (_, totals) in ROLLUPS.items():
        write_partitioned(totals(days), rollup_path(root, name), K.PARTITION_COLUMNS)


def read_rollup(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(ROLLUPS[name][0]).parquet(rollup_path(root, name))


def monthly_revenue(products: DataFrame) -> DataFrame:
    """Q1 from the daily product totals."""
    return A.monthly_revenue_of(_months(products))


def mom_growth(products: DataFrame) -> DataFrame:
    """Q5 from the daily product totals."""
    return A.mom_growth_of(_months(products))


def _months(products: DataFrame) -> DataFrame:
    return products.groupBy("year", "month").agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"), F.sum("transaction_count").alias("orders"))


def _sums(daily: DataFrame, key: str) -> DataFrame:
    counts = [c for c in ("transaction_count", "units_sold") if c in daily.columns]
    return daily.groupBy(key).agg(F.sum("revenue").cast(TOTAL).alias("revenue"), *[F.sum(c).alias(c) for c in counts])


def top_products(daily: DataFrame, products: DataFrame, k: int | None = 10, measure: str = "revenue",
                 by: str = "name", **bounds) -> DataFrame:
    """Q2 and its variants from the daily product totals."""
    return A.top_products_of(_sums(daily, "product_id"), products, k, measure, by, **bounds)


def avg_order_value(daily: DataFrame, products: DataFrame, **bounds) -> DataFrame:
    """Q4 from the daily product totals."""
    return A.avg_order_value_of(_sums(daily, "product_id"), products, **bounds)


def top_customers(daily: DataFrame, customers: DataFrame, k: int | None = 20, **bounds) -> DataFrame:
    """Q3 from the daily customer totals."""
    return A.top_customers_of(_sums(daily, "customer_id"), customers, k, **bounds)


def curated_count(products: DataFrame) -> DataFrame:
    """A11 from the daily product totals."""
    return products.agg(F.coalesce(F.sum("transaction_count"), F.lit(0).cast("long")).alias("curated_count"))
