"""K1-K5: rerun-safe writers.

Curated facts and metrics use dynamic partition overwrite as a write option
(not a session setting): a write replaces exactly the partitions present in
the frame, so rerunning a batch replaces its days instead of appending
copies. A batch must therefore carry complete days (see ``merge_existing``).

Before a partitioned write the rows are rebalanced on the partition columns
(``REBALANCE`` hint): one shuffle brings each day to few tasks, so a day is a
few large files rather than one small file per upstream task, and AQE splits
a day that is much larger than the others across several tasks.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity import constants as K
from verity import schemas
from verity.functions.names import standardize_column_names
from verity.operators.conform import conform
from verity.session import path_exists, qualified, remove_path, source_roots, swap_path, versions_root


def configure_dynamic_overwrite(spark: SparkSession) -> None:
    """K1, session-wide: every overwrite of a partitioned table in this
    session replaces only the partitions present in the written frame. The
    writers here set the same mode per write and do not need it."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


class Written:
    """Row count and partitions of a frame, gathered by the write that
    consumes it: one small row at the end, no second pass. Put last before
    the write, so that its tasks are the writing ones, whose figures Spark
    counts once however often a stage is repeated. The partitions of a batch
    are bounded by the calendar (or are one run)."""

    def __init__(self, columns: Sequence[str] = ()):
        self.columns, self.seen = tuple(columns), Observation()

    def of(self, df: DataFrame) -> DataFrame:
        parts = [F.collect_set(F.struct(*self.columns)).alias("parts")] if self.columns else []
        return df.observe(self.seen, F.count(F.lit(1)).alias("n"), *parts)

    def _row(self) -> dict:
        try:
            return self.seen.get
        except Py4JJavaError as e:
            # A frame that AQE found empty was planned away with its
            # observation, whose row has no schema: Spark asserts against it.
            if e.java_exception.getClass().getName() != "java.lang.AssertionError":
                raise
            return {}

    def rows(self) -> int:
        return int(self._row().get("n") or 0)

    def partitions(self) -> list[dict[str, str]]:
        found = self._row().get("parts") or []
        return sorted(({c: p[c] for c in self.columns} for p in found),
                      key=lambda p: [p[c] or "" for c in self.columns])


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], rebalance: Sequence[str] | None = None,
                      max_records_per_file: int | None = None, fresh: bool = False) -> Written:
    """K1: replace the partitions present in the frame, and only these.
    ``rebalance``: the columns that deal the rows to tasks (default: the
    partition columns). ``fresh``: the folder is new and nobody reads it yet,
    so every task puts its files in place itself, instead of the driver moving
    one folder after the other at the end. Returns what was written."""
    written = Written(partition_by)
    w = (written.of(df.hint("rebalance", *(partition_by if rebalance is None else rebalance)))
         .write.partitionBy(*partition_by))
    if fresh:
        w = w.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    else:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return written


def write_curated(df: DataFrame, path: str, max_records_per_file: int | None = 5_000_000) -> Written:
    """K2: curated facts, partitioned by year, month, day (text)."""
    return write_partitioned(df.select(*schemas.names(schemas.CURATED_TRANSACTIONS)), path,
                             K.PARTITION_COLUMNS, max_records_per_file=max_records_per_file)


def write_rejected(df: DataFrame, path: str, run_id: str,
                   max_records_per_file: int | None = 5_000_000) -> Written:
    """K3: rejected rows of one run under ``run_id=<id>``, which all of them
    must carry. Dynamic overwrite replaces the run's folder; a rerun without
    rejects empties it. The rows are rebalanced without a key: a run is one
    partition."""
    spark = df.sparkSession
    written = write_partitioned(df.select(*schemas.names(schemas.REJECTED_TRANSACTIONS)), path, ("run_id",), (),
                                max_records_per_file)
    if not written.partitions():
        stale = run_folder(spark, path, run_id)
        if path_exists(spark, stale):
            spark.createDataFrame([], schemas.REJECTED_TRANSACTIONS).drop("run_id").write.mode("overwrite").parquet(stale)
    return written


def run_folder(spark: SparkSession, path: str, run_id: str) -> str:
    """The folder Spark gives the partition of a run."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    return f"{path.rstrip('/')}/run_id={name}"


def metrics_frame(spark: SparkSession, counts: dict, stage: str, run_id: str,
                  ts: str | None = None) -> DataFrame:
    ts = ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    row = (run_id, stage, int(counts["raw_count"]), int(counts["rejected_count"]),
           int(counts["curated_count"]), ts)
    return spark.createDataFrame([row], schemas.RUN_METRICS)


def write_run_metrics(spark: SparkSession, counts: dict, stage: str, path: str, run_id: str,
                      ts: str | None = None) -> None:
    """K4: one row per run and stage. Partitioned by both with dynamic
    overwrite, so a retried stage replaces its row instead of adding one."""
    (metrics_frame(spark, counts, stage, run_id, ts).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "stage").parquet(path))


def publish_frame(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """K5 transform: standard names, trimmed key, declared types."""
    std = standardize_column_names(df)
    return conform(std.withColumn(key, F.trim(F.col(key))), schema)


def publish_dimension(df: DataFrame, schema: T.StructType, key: str, path: str) -> None:
    """K5: republish a dimension in full. Refuses a path the frame reads from,
    however either is spelt. The typed rows are written once, beside the path,
    and the finished folder is put in its place, so a failing cast or read
    leaves the old rows and no reader finds a half-written table."""
    spark = df.sparkSession
    target = qualified(spark, path) + "/"
    if any((qualified(spark, root) + "/").startswith(target) for root in source_roots(df)):
        raise ValueError(f"{path} is an input of the frame being published")
    fresh = f"{versions_root(path)}/{uuid.uuid4().hex}"
    try:
        publish_frame(df, schema, key).write.parquet(fresh)
        swap_path(spark, fresh, path)
        spark.catalog.refreshByPath(path)
    finally:
        remove_path(spark, fresh)
