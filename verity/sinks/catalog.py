"""K6, K7: table definitions over the written paths, and their partitions.

A batch registers the partitions it wrote (``add_partitions``); a repair, which
lists every folder of a table, is for a table defined over folders that are
already there and for the separate stage 2. A partition or an unpartitioned
table may point into a folder of versions beside its path (see
``verity.sinks.release``).
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from verity import constants as K
from verity import schemas
from verity.session import path_exists, qualified, versions_root

GROUP = 200  # partitions named by one ALTER TABLE


def _cols(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(partition: dict[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"`{c}`={_text(v)}" for c, v in partition.items()) + ")"


def _groups(items: Iterable, size: int = GROUP):
    items = list(items)
    return (items[i:i + size] for i in range(0, len(items), size))


def _described(spark: SparkSession, what: str) -> dict[str, str]:
    """The named facts of a table or partition; a partition's own location
    comes before its table's."""
    out: dict[str, str] = {}
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {what}").collect():
        out.setdefault(row["col_name"], row["data_type"])
    return out


def partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The partitions a table knows, as column to text."""
    return [dict((c, unquote(v)) for c, v in (part.split("=", 1) for part in row[0].split("/")))
            for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def location(spark: SparkSession, table: str, partition: dict[str, str] | None = None) -> str:
    return _described(spark, f"{table} {_spec(partition)}" if partition else table)["Location"]


def set_location(spark: SparkSession, table: str, folder: str, partition: dict[str, str] | None = None) -> None:
    """Point a partition, or a whole unpartitioned table, to another folder."""
    where = f"{_spec(partition)} " if partition else ""
    spark.sql(f"ALTER TABLE {table} {where}SET LOCATION {_text(folder)}")


def add_partitions(spark: SparkSession, table: str, specs: Iterable[dict[str, str]],
                   folders: Sequence[str] | None = None) -> None:
    """Make partitions known, at their usual folders or the given ones; those
    already known stay as they are."""
    specs = list(specs)
    places = [f" LOCATION {_text(f)}" for f in folders] if folders else [""] * len(specs)
    for group in _groups(zip(specs, places)):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(_spec(s) + p for s, p in group))


def drop_partitions(spark: SparkSession, table: str, specs: Iterable[dict[str, str]]) -> None:
    """Forget partitions of an external table; their files stay."""
    for group in _groups(specs):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(_spec, group)))


def define_table(spark: SparkSession, table: str, schema: T.StructType, path: str,
                 partitioned_by: tuple[str, ...] = ()) -> bool:
    """Define an external table over ``path`` if there is none. An external
    table of that name elsewhere is pointed to ``path`` and forgets its
    partitions; its files stay. A managed table or a view of that name is an
    error: neither may lose what it holds. Returns whether the partitions have
    yet to be found in the folders."""
    if not spark.catalog.tableExists(table):
        part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_cols(schema)}) USING PARQUET{part} LOCATION {_text(path)}")
        return True
    facts = _described(spark, table)
    if facts.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} is a {facts.get('Type', 'temporary').lower()} table or view, "
                         f"not an external table over {path}")
    here = qualified(spark, facts["Location"])
    if here == qualified(spark, path) or here.startswith(qualified(spark, versions_root(path)) + "/"):
        return False
    set_location(spark, table, path)
    if partitioned_by:
        drop_partitions(spark, table, partitions(spark, table))
    spark.catalog.refreshTable(table)
    return True


def create_tables(spark: SparkSession, curated_path: str, rejected_path: str, metrics_path: str,
                  customers_path: str, products_path: str,
                  curated_db: str = "curated", rejected_db: str = "rejected") -> dict[str, bool]:
    """Two databases, five tables: curated.transactions (year, month, day),
    curated.customers, curated.products, rejected.transactions (run_id),
    curated.run_metrics (run_id, stage). Idempotent; every table is external.
    Returns the partitioned tables, each with whether its partitions have yet
    to be found in the folders."""
    for db in (curated_db, rejected_db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    define_table(spark, f"{curated_db}.customers", schemas.CURATED_CUSTOMERS, customers_path)
    define_table(spark, f"{curated_db}.products", schemas.CURATED_PRODUCTS, products_path)
    return {name: define_table(spark, name, schema, path, keys) for name, schema, path, keys in (
        (f"{curated_db}.transactions", schemas.CURATED_TRANSACTIONS, curated_path, K.PARTITION_COLUMNS),
        (f"{rejected_db}.transactions", schemas.REJECTED_TRANSACTIONS, rejected_path, ("run_id",)),
        (f"{curated_db}.run_metrics", schemas.RUN_METRICS, metrics_path, ("run_id", "stage")))}


def repair_partitions(spark: SparkSession, *tables: str) -> None:
    """K7: make partition folders visible by listing them (MSCK REPAIR); a
    table whose folder is not there yet has none."""
    for t in tables:
        if path_exists(spark, location(spark, t)):
            spark.catalog.recoverPartitions(t)
