"""Test inputs shaped like the pipeline's raw tables, derived from the
TPC-H-style tables under ``/root/testdata``.

Defects are chosen by ``h = l_orderkey*31 + l_linenumber*17 + l_partkey`` so
the rows are the same on every engine. ``lineitem`` repeats
``(l_orderkey, l_linenumber)`` naturally, which yields duplicate
transaction ids for the dedupe step.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.operators.references import DEFAULT_BROADCAST_MAX_ROWS, fits_broadcast

FIXTURE_MIN_DATE = "1995-01-01"
FIXTURE_MAX_DATE = "2001-12-31"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a scan that has fewer splits than the cluster has
    cores (a file with one row group is one task however large it is), so
    the per-row work above it runs on every core. A large input already has
    many splits and is left alone: no shuffle is added at scale."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (e.g. a Spark Connect session)
        return df
    return df if splits >= cores else df.repartition(cores, *keys)


def _small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a join side only when it is counted below the bound."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    n = _small(_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    r = _small(_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.concat(F.lit("C"), _s("c_custkey")).alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.concat(F.lit("u"), _s("c_custkey"), F.lit("@example.com")).alias("email"),
                    F.lower("r_name").alias("region"),
                    F.concat(F.lit("20"), F.lpad(_s(F.lit(22) + F.col("c_custkey") % 3), 2, "0"),
                             F.lit("-01-15")).alias("signup_date")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), _s("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders grow with lineitem: never broadcast by the library, so that the
    # plan is the same at every size.
    li = spread(_table(spark, sf_dir, "lineitem"), "l_orderkey")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    b = li.join(o, li.l_orderkey == o.o_orderkey).withColumn(
        "h", F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey"))
    h = F.col("h")
    cust = _s("o_custkey")
    ship = F.col("l_shipdate")
    price = F.col("l_extendedprice")
    return b.select(
        F.concat(F.lit("T"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("transaction_id"),
        F.when(h % 60 == 1, F.lit(""))
         .when(h % 120 == 2, F.lit(None).cast("string"))
         .when(h % 70 == 5, F.lit("C-UNKNOWN"))
         .when(h % 50 == 3, F.concat(F.lit("  C"), cust, F.lit(" ")))
         .otherwise(F.concat(F.lit("C"), cust)).alias("customer_id"),
        F.when(h % 70 == 6, F.lit("P-UNKNOWN"))
         .otherwise(F.concat(F.lit("P"), _s("l_partkey"))).alias("product_id"),
        F.when(h % 240 == 10, F.lit("2031-01-01"))
         .when(h % 240 == 90, F.lit("not-a-date"))
         .when(h % 240 == 170, F.lit("2019-13-40"))
         .when(h % 10 < 7, F.date_format(ship, "yyyy-MM-dd"))
         .otherwise(F.date_format(ship, "MM/dd/yyyy")).alias("transaction_date"),
        F.when(h % 60 == 7, F.lit(""))
         .when(h % 240 == 8, F.lit("0.00"))
         .when(h % 240 == 88, F.lit("-45.00"))
         .when(h % 240 == 168, F.lit("N/A"))
         .when(h % 997 == 0, F.lit("99999999999.00"))
         .when(h % 500 == 9, F.format_string("%.2f", price * 20))
         .when(h % 10 < 5, F.format_string("%.2f", price))
         .when(h % 10 < 8, F.concat(F.lit("$"), F.format_number(price, 2)))
         .otherwise(F.format_number(price, 2)).alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(h % 25 == 10, F.lit(None).cast("string"))
         .when(h % 5 < 3, F.lit(""))
         .when(h % 5 == 3, F.lit("SAVE10"))
         .otherwise(F.lit("WELCOME5")).alias("promo_code"),
        F.date_format(ship + F.make_dt_interval(F.lit(0), (F.col("l_suppkey") % 48 + 1).cast("int")),
                      "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
        F.concat(F.lit("batch_"), F.col("l_linestatus"), F.lit(".csv")).alias("source_file"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(raw_transactions, customers, products)`` for one scale factor."""
    return raw_transactions(spark, sf_dir), customers(spark, sf_dir), products(spark, sf_dir)
