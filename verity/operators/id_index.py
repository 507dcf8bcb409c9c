"""On which days does a keyed table hold an id?

The index is a narrow table ``id, day`` in folders by a hash bucket of the id
and by the run that wrote the rows. Every batch adds its own rows before it
writes the table itself, so the index may name a day too many, never one too
few: a superfluous day costs a read, a missing one would cost correctness.
Nothing is rewritten when rows move; ``build_index`` starts afresh from the
table's id and day columns.

A lookup reads the buckets of the asked ids alone (a partition filter) and
joins inside them; the table itself is not read.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.operators.references import DEFAULT_BROADCAST_MAX_ROWS, fits_broadcast
from verity.session import path_exists, remove_path, swap_path

BUCKETS = 256
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "day")]
                      + [T.StructField("bucket", T.IntegerType()), T.StructField("run", T.StringType())])


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def index_path(root: str, buckets: int = BUCKETS) -> str:
    """The number of buckets is part of the path: another number is another index."""
    return f"{root.rstrip('/')}/buckets-{buckets}"


def _rows(table: DataFrame, key: str, day: Sequence[str], run: str, buckets: int) -> DataFrame:
    return table.select(F.col(key).cast("string").alias("id"), F.concat_ws("-", *day).alias("day"),
                        bucket_of(F.col(key).cast("string"), buckets).alias("bucket"), F.lit(run).alias("run"))


def _write(rows: DataFrame, path: str, fresh: bool = False) -> None:
    """Sorted by id within a file, so that Parquet's statistics help a lookup.
    Tasks put files into a new folder themselves; into one in use, the driver
    moves them at the end."""
    w = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "id").write.partitionBy("bucket", "run")
    if fresh:
        w = w.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    else:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def build_index(table: DataFrame, root: str, key: str, day: Sequence[str], buckets: int = BUCKETS) -> None:
    """The index of a whole table, in place of any there is."""
    path = index_path(root, buckets)
    fresh = f"{path}.new"
    remove_path(table.sparkSession, fresh)
    _write(_rows(table, key, day, "table", buckets), fresh, fresh=True)
    swap_path(table.sparkSession, fresh, path)


def has_index(spark: SparkSession, root: str, buckets: int = BUCKETS) -> bool:
    return path_exists(spark, index_path(root, buckets))


def add_to_index(batch: DataFrame, root: str, key: str, day: Sequence[str], run: str, buckets: int = BUCKETS) -> None:
    """Add a run's rows; the same run again replaces its own."""
    _write(_rows(batch, key, day, run, buckets), index_path(root, buckets))


def read_index(spark: SparkSession, root: str, buckets: int = BUCKETS) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(index_path(root, buckets))


def lookup(index: DataFrame, ids: DataFrame, key: str, buckets: int = BUCKETS,
           broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``id, day`` of the asked ids. The asked buckets (at most ``buckets``
    numbers) are read first and restrict the scan; the asked ids, pre-reduced
    to distinct ones, are broadcast only if counted below the bound, else both
    sides are joined by bucket and id."""
    asked = ids.select(F.col(key).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    touched = [r[0] for r in asked.select(bucket_of("id", buckets)).distinct().collect()]
    asked = asked.withColumn("bucket", bucket_of("id", buckets))
    if fits_broadcast(asked, broadcast_max_rows):
        asked = F.broadcast(asked)
    return (index.where(F.col("bucket").isin(touched)).select("bucket", "id", "day")
            .join(asked, ["bucket", "id"], "left_semi").select("id", "day"))
