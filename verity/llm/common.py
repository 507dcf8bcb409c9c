"""Helpers shared by the training-data operators: staged tables in the shared
checkpoint folder, Arrow batch bounds, and word handling."""
from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.session import ensure_checkpoint_dir, remove_path

# A word, for every operator but the licence scan: a run of characters other
# than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_FOLDERS: list[tuple[SparkSession, str]] = []


def _remove_folders() -> None:
    for spark, path in _FOLDERS:
        remove_path(spark, path)


atexit.register(_remove_folders)


class Staging:
    """Tables one operator call writes under ``spark.checkpoint.dir``.

    A staged table cuts the lineage: a lost executor rereads files that every
    executor shares. ``drop`` frees a table no later plan reads; what the
    returned frame still reads goes when the process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        _FOLDERS.append((spark, self.root))

    def write(self, df: DataFrame, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        for table in tables:
            remove_path(self.spark, f"{self.root}/{table}")


def bound_arrow_batches(spark: SparkSession, rows: int = 1000, nbytes: int = 2 << 20) -> None:
    """Bound what one Arrow batch holds, in rows and in bytes, so very long
    texts cannot fill a Python worker. The setting is read when the (lazy)
    plan runs, so it stays on the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(nbytes))


def release_free_memory() -> None:
    """Give memory that Arrow's and the C allocator hold free back to the
    system (the second where the C library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after whose last batch the worker releases what it holds free.
    Spark keeps workers for later tasks and stages, so what one step has freed
    would stay beside the memory the next one needs."""
    @wraps(run)
    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_free_memory()
    return released


def text_of(col: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(col: str | Column) -> Column:
    return F.regexp_count(text_of(col), F.lit(WORD)).cast("long")
