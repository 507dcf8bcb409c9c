"""Keep one row per key, chosen by a total order.

``row_number() ... = 1`` lets Catalyst place a partial ``WindowGroupLimit``
before the shuffle, so a key repeated millions of times leaves each map task
as one row: a hot key does not become a hot reducer.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
           tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order``.

    ``tie_break`` columns (default: every other column, ascending, NULLs
    first) are appended to the order so the survivor is the same on every
    run, whatever the input partitioning.
    """
    if tie_break is None:
        named = set(keys)
        tie_break = [c for c in df.columns if c not in named]
    full = list(order) + [F.col(c).asc_nulls_first() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*full)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))
