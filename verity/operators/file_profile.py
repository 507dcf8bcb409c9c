"""S2 by file: which raw file departs from the declared schema, and how.

The landing zone is read as lines, so files with other headers are profiled
rather than refused. Two scans: the first takes every file's header line, the
second splits the data lines and adds up, per file and column, how many values
are missing, have each candidate type's shape, or fail the declared type. The
cells of a file never meet in one task before they are counted.

Lines are records (a quoted line break is not supported, as in the raw scan);
a line equal to its file's header counts as a repeated header, not as data.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.operators.profile import DEFAULT_CANDIDATES
from verity.operators.references import DEFAULT_BROADCAST_MAX_ROWS, fits_broadcast


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")))


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``header``: the first line of every file that has one."""
    return (_lines(spark, path).where("block = 0").groupBy("file")
            .agg(F.min_by("line", "at").alias("header")))


def _clean(name: Column) -> Column:
    """A header cell under the rule of ``clean_name``."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), " ", "_"), "-", "_")


def _cells(line: Column, width: int) -> Column:
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names),
                        {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return F.array(*[parsed[n] for n in names])


def file_profile(spark: SparkSession, path: str, declared: T.StructType, typed: T.StructType | None = None,
                 candidates: Sequence[tuple[str, str, str]] = DEFAULT_CANDIDATES,
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """One row per file and column: ``file``, ``column_name``, ``position``
    (from 0; NULL for a declared column the file lacks), ``n_rows``,
    ``n_null`` (missing or empty cells), ``n_<type>`` per candidate,
    ``n_uncastable`` (values the column's type in ``typed`` refuses; NULL
    where it names none), ``declared`` (whether the column is) and
    ``departs``: the column is not declared, lacking, at another position
    than declared, or holds a value its type refuses."""
    want = [f.name for f in declared.fields]
    types = {f.name: f.dataType.simpleString() for f in (typed or T.StructType([])).fields}
    headers = file_headers(spark, path)
    # Quoted commas only make this too large, which adds empty cells.
    width = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0]
    if width is None:
        return spark.createDataFrame([], _schema(candidates))
    heads = headers.withColumn("names", F.filter(_cells(F.col("header"), width), lambda c: c.isNotNull()))
    heads = heads.withColumn("names", F.transform("names", _clean))
    small = F.broadcast(heads) if fits_broadcast(heads.select("file", "header"), broadcast_max_rows) else heads
    rows = (_lines(spark, path).join(small, "file").where((F.col("line") != F.col("header")) & (F.trim("line") != ""))
            .select("file", "names", _cells(F.col("line"), width).alias("cells")))
    cells = (rows.select("file", F.posexplode(F.slice(F.arrays_zip("names", "cells"), 1, F.size("names")))
                         .alias("position", "z"))
             .select("file", "position", F.col("z.names").alias("column_name"),
                     F.nullif(F.col("z.cells"), F.lit("")).alias("text")))
    refused = None
    for name, kind in types.items():
        fails = (F.col("column_name") == name) & F.col("text").isNotNull() & F.col("text").try_cast(kind).isNull()
        refused = fails if refused is None else refused | fails
    shapes = [F.count_if(F.coalesce(F.col("text").rlike(shape) & F.col("text").try_cast(cast).isNotNull(), F.lit(False)))
              .alias(f"n_{name}") for name, shape, cast in candidates]
    found = cells.groupBy("file", "position", "column_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("text").isNull()).alias("n_null"), *shapes,
        F.count_if(F.coalesce(refused, F.lit(False)) if refused is not None else F.lit(False)).alias("n_refused"))
    # Every column of every header, also of a file without data, and every declared one a header lacks.
    listed = heads.select("file", F.posexplode("names").alias("position", "column_name"))
    lacking = heads.select("file", F.explode(F.array_except(F.array(*[F.lit(c) for c in want]), "names"))
                           .alias("column_name")).select("file", F.lit(None).cast("int").alias("position"), "column_name")
    out = listed.join(found, ["file", "position", "column_name"], "left").unionByName(lacking, allowMissingColumns=True)
    zero = F.lit(0).cast("long")
    place = F.array_position(F.array(*[F.lit(c) for c in want]), F.col("column_name")) - 1
    is_declared = F.col("column_name").isin(want)
    uncastable = F.when(F.col("column_name").isin(list(types)), F.coalesce("n_refused", zero))
    return out.select(
        "file", "column_name", "position", F.coalesce("n_rows", zero).alias("n_rows"),
        F.coalesce("n_null", zero).alias("n_null"),
        *[F.coalesce(f"n_{name}", zero).alias(f"n_{name}") for name, _, _ in candidates],
        uncastable.alias("n_uncastable"), is_declared.alias("declared"),
        (~is_declared | F.col("position").isNull() | (F.col("position") != place)
         | (F.coalesce(uncastable, zero) > 0)).alias("departs"))


def _schema(candidates) -> str:
    shapes = "".join(f"n_{name} long, " for name, _, _ in candidates)
    return (f"file string, column_name string, position int, n_rows long, n_null long, {shapes}"
            "n_uncastable long, declared boolean, departs boolean")
