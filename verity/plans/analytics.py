"""Q1-Q7 and the later variants, over the curated tables.

Money is summed exactly in decimal and handed out as DOUBLE. Queries that
join the fact table to a dimension aggregate the fact per key first: the
partial aggregate on every map task turns billions of rows into one row per
product (or customer) before anything is shuffled or joined, and a key that
holds a third of all rows costs no more than any other. Top-k cuts add the
entity name or id as tie-breaker so the cut is deterministic.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verity.operators.references import DEFAULT_BROADCAST_MAX_ROWS, fits_broadcast


def _dim(dim: DataFrame, cols: tuple[str, ...], max_rows: int) -> DataFrame:
    """A dimension projection, broadcast only when counted below the bound;
    otherwise the join of two per-key aggregates is a plain shuffle join."""
    proj = dim.select(*cols)
    return F.broadcast(proj) if fits_broadcast(dim, max_rows, columns=cols) else proj



def _date_range(curated: DataFrame, start=None, end=None) -> DataFrame:
    """Optional inclusive date range. The bound on ``year`` is a filter on a
    partition column, so whole years are pruned at the scan; the bound on
    the date itself keeps the answer exact."""
    df = curated
    if start is not None:
        s = dt.date.fromisoformat(str(start)[:10])
        df = df.where((F.col("year") >= F.lit(f"{s.year:04d}"))
                      & (F.col("transaction_date") >= F.lit(s.isoformat()).cast("date")))
    if end is not None:
        e = dt.date.fromisoformat(str(end)[:10])
        df = df.where((F.col("year") <= F.lit(f"{e.year:04d}"))
                      & (F.col("transaction_date") <= F.lit(e.isoformat()).cast("date")))
    return df


def _money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _monthly(curated: DataFrame, start=None, end=None) -> DataFrame:
    return (_date_range(curated, start, end).groupBy("year", "month")
            .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders")))


def monthly_revenue(curated: DataFrame, start=None, end=None) -> DataFrame:
    """Q1: revenue and order count per year and month."""
    return monthly_revenue_of(_monthly(curated, start, end))


def monthly_revenue_of(monthly: DataFrame) -> DataFrame:
    """Q1 from one row per month (year, month, revenue, orders)."""
    return (monthly.select("year", "month", _money("revenue").alias("revenue"), "orders")
            .orderBy("year", "month"))


def mom_growth(curated: DataFrame, start=None, end=None) -> DataFrame:
    """Q5: change against the previous month present in the data. The
    unpartitioned window runs on the monthly aggregate only (one row per
    month), never on transaction rows."""
    return mom_growth_of(_monthly(curated, start, end))


def mom_growth_of(monthly: DataFrame) -> DataFrame:
    """Q5 from one row per month."""
    w = Window.orderBy("year", "month")
    return (monthly.select("year", "month", _money("revenue").alias("revenue"),
                     _money(F.col("revenue") - F.lag("revenue").over(w)).alias("mom_change"))
            .orderBy("year", "month"))


def _per_product(curated: DataFrame) -> DataFrame:
    return curated.groupBy("product_id").agg(
        F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("transaction_count"),
        F.sum("quantity").alias("units_sold"))


MEASURES = {"revenue": "revenue", "orders": "transaction_count", "units": "units_sold"}


def top_products(curated: DataFrame, products: DataFrame, k: int | None = 10,
                 measure: str = "revenue", by: str = "name",
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                 start=None, end=None) -> DataFrame:
    """Q2 and the volume / units variants.

    ``by="name"`` groups on product name as the reference does (products
    sharing a name merge); ``by="id"`` keeps id and name apart.
    ``measure``: revenue, orders (``transaction_count``) or units
    (``units_sold``). ``k=None`` returns every product.
    """
    return top_products_of(_per_product(_date_range(curated, start, end)), products, k, measure, by,
                           broadcast_max_rows)


def top_products_of(per_id: DataFrame, products: DataFrame, k: int | None = 10, measure: str = "revenue",
                    by: str = "name", broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Q2 from one row of totals per product id."""
    col = MEASURES[measure]
    keys = ["product_name"] if by == "name" else ["product_id", "product_name"]
    per_id = per_id.select("product_id", col)
    dim = _dim(products, ("product_id", "product_name"), broadcast_max_rows)
    out = per_id.join(dim, "product_id").groupBy(*keys).agg(F.sum(col).alias(col))
    if measure == "revenue":
        out = out.withColumn(col, _money(col))
    ordered = out.orderBy(F.col(col).desc(), *[F.col(c).asc() for c in keys])
    return ordered.limit(k) if k else ordered


def top_customers(curated: DataFrame, customers: DataFrame, k: int | None = 20,
                  broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                  start=None, end=None) -> DataFrame:
    """Q3 (k=20) and the k=10 variant: lifetime spend and orders."""
    per_id = _date_range(curated, start, end).groupBy("customer_id").agg(
        F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("transaction_count"))
    return top_customers_of(per_id, customers, k, broadcast_max_rows)


def top_customers_of(per_id: DataFrame, customers: DataFrame, k: int | None = 20,
                     broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Q3 from one row of totals per customer id."""
    dim = _dim(customers, ("customer_id", "customer_name"), broadcast_max_rows)
    out = (per_id.join(dim, "customer_id").groupBy("customer_id", "customer_name")
           .agg(F.sum("revenue").alias("lifetime_spend"), F.sum("transaction_count").alias("orders"))
           .select("customer_id", "customer_name", _money("lifetime_spend").alias("lifetime_spend"),
                   "orders"))
    ordered = out.orderBy(F.col("lifetime_spend").desc(), F.col("customer_id").asc(),
                          F.col("customer_name").asc())
    return ordered.limit(k) if k else ordered


def avg_order_value(curated: DataFrame, products: DataFrame,
                    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                    start=None, end=None) -> DataFrame:
    """Q4: average amount per category, rounded to cents, from an exact sum
    and count (engines disagree on the type of a decimal AVG)."""
    return avg_order_value_of(_per_product(_date_range(curated, start, end)), products, broadcast_max_rows)


def avg_order_value_of(per_id: DataFrame, products: DataFrame,
                       broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Q4 from one row of totals per product id."""
    dim = _dim(products, ("product_id", "category"), broadcast_max_rows)
    out = (per_id.join(dim, "product_id")
           .groupBy("category").agg(F.sum("revenue").alias("s"), F.sum("transaction_count").alias("orders")))
    return (out.select("category",
                       F.round(_money("s") / F.col("orders"), 2).alias("avg_order_value"),
                       "orders")
            .orderBy(F.col("avg_order_value").desc(), F.col("category").asc()))


def reject_rate(rejected: DataFrame) -> DataFrame:
    """Q6: rejected rows per reason and their share of all rejects. The
    share's window runs over the grouped rows (one per reason)."""
    g = rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows_rejected"))
    share = F.round(F.col("rows_rejected") * F.lit(100.0).cast("decimal(4,1)")
                    / F.sum("rows_rejected").over(Window.partitionBy()), 2)
    return (g.select("reject_reason", "rows_rejected", _money(share).alias("pct_of_all_rejects"))
            .orderBy(F.col("rows_rejected").desc(), F.col("reject_reason").asc()))


def curated_count(curated: DataFrame, start=None, end=None) -> DataFrame:
    return _date_range(curated, start, end).agg(F.count(F.lit(1)).alias("curated_count"))


def run_health(run_metrics: DataFrame) -> DataFrame:
    """Q7: counts and reject percentage per run, newest first."""
    pct = F.round(F.col("rejected_count") * F.lit(100.0).cast("decimal(4,1)")
                  / F.nullif(F.col("raw_count"), F.lit(0)), 2)
    return (run_metrics.select("run_id", "stage", "raw_count", "rejected_count", "curated_count",
                               _money(pct).alias("pct_rejected"), "ts")
            .orderBy(F.col("ts").desc(), F.col("run_id").asc(), F.col("stage").asc()))


def metrics_by_source(tagged: DataFrame, curated: DataFrame, stage: str) -> DataFrame:
    """Run-metrics rows derived from data: one per ``source_file`` treated as
    a run. raw and rejected counts come from the tagged rows, curated from
    the surviving rows, ts is the newest ingestion time as ISO text. Two
    aggregates joined on a key with one row per side."""
    raw = tagged.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected_count"),
        F.max("ingestion_timestamp").alias("max_ts"))
    cur = curated.groupBy("source_file").agg(F.count(F.lit(1)).alias("curated_count"))
    return (raw.join(cur, "source_file", "left")
            .select(F.col("source_file").alias("run_id"), F.lit(stage).alias("stage"),
                    "raw_count", "rejected_count",
                    F.coalesce("curated_count", F.lit(0).cast("long")).alias("curated_count"),
                    F.date_format("max_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts")))
