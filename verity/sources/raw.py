"""The raw CSV landing zone."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.functions.names import clean_name


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A directory of headed CSV files as text columns in ``schema`` order.

    Header names are matched to ``schema`` after name standardisation, so
    ``" Transaction ID "`` finds ``transaction_id`` and the file's column
    order does not matter. Nothing is inferred: only the header line of one
    file is read up front. Values are kept as text; typing is the
    pipeline's job.
    """
    header = spark.read.option("header", True).csv(path).columns
    clean = [clean_name(h) for h in header]
    wanted = [f.name for f in schema.fields]
    missing = [c for c in wanted if c not in clean]
    if missing:
        raise ValueError(f"{path}: header lacks columns {missing} (found {header})")
    # The raw header names form the read schema and enforceSchema is off, so
    # Spark checks every file's header against it while scanning: a file
    # with other columns or another order fails instead of being misread.
    file_schema = T.StructType([T.StructField(h, T.StringType(), True) for h in header])
    df = (spark.read.schema(file_schema).option("header", True)
          .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)).toDF(*clean)
    return df.select(*[F.col(c).cast(f.dataType).alias(c) if f.dataType != T.StringType()
                       else F.col(c) for c, f in zip(wanted, schema.fields)])


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """What a crawler would infer: Spark's CSV type inference over the files
    (one pass, or a sample of the rows)."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("samplingRatio", sampling_ratio).csv(path).schema)


def drift_report(spark: SparkSession, path: str, declared: T.StructType,
                 sampling_ratio: float = 1.0) -> DataFrame:
    """One row per column: column_name, inferred_type, declared_type, matches.
    ``inferred_type`` is NULL when the files lack a declared column,
    ``declared_type`` when they hold one that is not declared."""
    inferred = {clean_name(f.name): f.dataType.simpleString()
                for f in infer_schema(spark, path, sampling_ratio).fields}
    rows = [(f.name, inferred.get(f.name), f.dataType.simpleString(),
             inferred.get(f.name) == f.dataType.simpleString()) for f in declared.fields]
    known = {f.name for f in declared.fields}
    rows += [(name, kind, None, False) for name, kind in inferred.items() if name not in known]
    return spark.createDataFrame(
        rows, "column_name string, inferred_type string, declared_type string, matches boolean")
