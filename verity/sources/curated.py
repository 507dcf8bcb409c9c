"""Curated, rejected and metrics tables with declared schemas.

Reading with the declared schema keeps partition values as text
(``month=01`` stays ``'01'``); a schema-less path read would infer int.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from verity import schemas


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.CURATED_TRANSACTIONS)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.REJECTED_TRANSACTIONS)


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.RUN_METRICS)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _read(spark, path, schema)
