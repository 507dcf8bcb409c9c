"""The analytics as Spark SQL text over the catalog tables.

For users who keep their questions as SQL: after ``run_batch`` (or
``create_tables`` + ``repair_partitions``) these run unchanged through
``spark.sql``. They compute the same values as ``verity.plans.analytics``;
money is summed exactly and cast to DOUBLE, top-k cuts have a tie-breaker.
Questions over one table have no text of their own: ``register_views`` offers
the DataFrame API's plans as views.

A question that needs a dimension first totals the facts per key
(``per_product``, ``per_customer``) and joins those totals, so a key that holds
much of the table meets the join as one row.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verity.plans import analytics as A


def _totals(name: str, key: str) -> str:
    return (f"WITH {name} AS (SELECT {key}, SUM(amount) AS money, COUNT(*) AS n, SUM(quantity) AS units "
            f"FROM curated.transactions GROUP BY {key})")


def _by_product(measure: str, label: str, out: str) -> str:
    """The ten products (by name) with the most of a measure."""
    return f"""{_totals('per_product', 'product_id')},
        named AS (
            SELECT product_name, SUM({measure}) AS total
            FROM per_product JOIN curated.products USING (product_id) GROUP BY product_name)
        SELECT product_name, {out.format('total')} AS {label} FROM named
        ORDER BY total DESC, product_name LIMIT 10"""


CATALOG_QUERIES: dict[str, str] = {
    "top_products": _by_product("money", "revenue", "CAST({} AS DOUBLE)"),
    "top_products_by_volume": _by_product("n", "transaction_count", "{}"),
    "top_products_by_units": _by_product("units", "units_sold", "{}"),
    "top_customers": f"""{_totals('per_customer', 'customer_id')}
        SELECT customer_id, customer_name, CAST(SUM(money) AS DOUBLE) AS lifetime_spend, SUM(n) AS orders
        FROM per_customer JOIN curated.customers USING (customer_id)
        GROUP BY customer_id, customer_name
        ORDER BY SUM(money) DESC, customer_id, customer_name LIMIT 20""",
    "avg_order_value": f"""{_totals('per_product', 'product_id')}
        SELECT category, ROUND(CAST(SUM(money) AS DOUBLE) / SUM(n), 2) AS avg_order_value, SUM(n) AS orders
        FROM per_product JOIN curated.products USING (product_id)
        GROUP BY category ORDER BY avg_order_value DESC, category""",
}

# Questions over one table: views over the DataFrame API's own plans.
CATALOG_VIEWS: dict[str, Callable[[SparkSession], DataFrame]] = {
    "monthly_revenue": lambda spark: A.monthly_revenue(spark.table("curated.transactions")),
    "mom_growth": lambda spark: A.mom_growth(spark.table("curated.transactions")),
    "curated_count": lambda spark: A.curated_count(spark.table("curated.transactions")),
    "reject_rate": lambda spark: A.reject_rate(spark.table("rejected.transactions")),
    "run_health": lambda spark: A.run_health(spark.table("curated.run_metrics")),
}


def register_views(spark: SparkSession, prefix: str = "verity_") -> list[str]:
    """Session views ``<prefix><question>`` for SQL users; returns their names."""
    names = []
    for name, ask in CATALOG_VIEWS.items():
        ask(spark).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def run_catalog_query(spark: SparkSession, name: str) -> DataFrame:
    return CATALOG_VIEWS[name](spark) if name in CATALOG_VIEWS else spark.sql(CATALOG_QUERIES[name])
