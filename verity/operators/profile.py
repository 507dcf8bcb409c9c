"""Which values of each text column look like each candidate type.

A value counts for a type when its text has the type's canonical shape and
casts to it (``try_cast``): the shape guard keeps the answer independent of
how lenient one engine's cast is (a date cast that also takes ``2025`` or a
trailing time, an integer cast that rounds ``1.5``). One aggregation pass
computes every count for every column; the single wide result row becomes one
row per column.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (name, shape, cast type): the candidate types of a text column.
DEFAULT_CANDIDATES: tuple[tuple[str, str, str], ...] = (
    ("bigint", r"^[+-]?[0-9]+$", "bigint"),
    ("double", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$", "double"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "date"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$",
     "timestamp"),
)


def schema_profile(df: DataFrame, declared: T.StructType | None = None,
                   candidates: Sequence[tuple[str, str, str]] = DEFAULT_CANDIDATES) -> DataFrame:
    """Per column: column_name, n_rows, n_null, n_<type> for each candidate,
    declared_type."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        text = F.col(c).cast("string")
        aggs.append(F.count_if(text.isNull()).alias(f"c{i}_null"))
        for name, shape, cast in candidates:
            ok = text.rlike(shape) & text.try_cast(cast).isNotNull()
            aggs.append(F.count_if(F.coalesce(ok, F.lit(False))).alias(f"c{i}_{name}"))
    wide = df.agg(*aggs)
    decl = {f.name: f.dataType.simpleString() for f in declared.fields} if declared else {}
    rows = [F.struct(
        F.lit(c).alias("column_name"),
        F.col("n_rows"),
        F.col(f"c{i}_null").alias("n_null"),
        *[F.col(f"c{i}_{name}").alias(f"n_{name}") for name, _, _ in candidates],
        F.lit(decl.get(c, df.schema[c].dataType.simpleString())).alias("declared_type"),
    ) for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))
