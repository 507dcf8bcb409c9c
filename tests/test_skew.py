"""Hot keys: one key holding a third of the rows is split, not sent to one task."""
import glob
import os

from pyspark.sql import functions as F

from verity.operators.references import check_reference
from verity.sinks.writers import write_curated

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_reference_check_splits_a_hot_key(spark):
    old = with_conf(spark, SKEW_CONF)
    try:
        n = 30_000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT"))
             .otherwise(F.concat(F.lit("C"), (F.col("id") % 500).cast("string"))).alias("customer_id"),
            F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))  # incompressible
        dim = spark.range(500).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id")) \
            .union(spark.createDataFrame([("HOT",)], "customer_id string"))
        out = check_reference(fact, "customer_id", dim, flag="ok", broadcast_max_rows=0)
        tally = out.agg(F.count(F.lit(1)), F.count_if("ok"), F.max("payload"))
        assert tuple(tally.collect()[0])[:2] == (n, n)
        plan = tally._jdf.queryExecution().executedPlan().toString()  # final AQE plan
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan, plan
    finally:
        restore(spark, old)


def test_hot_day_is_split_across_files(spark, tmpdir_path):
    old = with_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                            "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    try:
        rows = spark.range(20_000).select(
            F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
            F.lit("C1").alias("customer_id"), F.lit("P1").alias("product_id"),
            F.lit(1).cast("decimal(10,2)").alias("amount"),
            F.when(F.col("id") % 100 == 0, F.lit("2025-01-02")).otherwise(F.lit("2025-01-01"))
             .cast("date").alias("transaction_date"),
            F.lit(1).alias("quantity"), F.lit("NONE").alias("promo_code"), F.lit(True).alias("is_imputed"),
            F.lit(None).cast("timestamp").alias("ingestion_timestamp"), F.lit("f").alias("source_file"),
            F.lit("r").alias("run_id"))
        rows = rows.select("*", F.date_format("transaction_date", "yyyy").alias("year"),
                           F.date_format("transaction_date", "MM").alias("month"),
                           F.date_format("transaction_date", "dd").alias("day"))
        path = os.path.join(tmpdir_path, "curated")
        write_curated(rows, path)
        hot = glob.glob(os.path.join(path, "year=2025", "month=01", "day=01", "*.parquet"))
        cold = glob.glob(os.path.join(path, "year=2025", "month=01", "day=02", "*.parquet"))
        assert len(hot) > 1 and len(cold) == 1
        assert spark.read.parquet(path).count() == 20_000
    finally:
        restore(spark, old)
