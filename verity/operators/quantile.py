"""A3: percentile of a column, exact and distributed.

``percentile_disc`` as an aggregate keeps a map of every distinct value in a
single final task, which does not survive a 100 TB input. The exact mode here
gives the same answer (the first value whose cumulative share reaches ``p``)
from a few histogram passes instead. Each pass is a ``groupBy(cell)``: a map
task sends at most ``BUCKETS`` + 2 partial counts, spread over the reducers by
cell, and at most as many rows reach the driver. The first range is the
decimal type's declared one, or ``min``/``max`` for integers; each pass narrows
it ``BUCKETS``-fold until a cell is one value wide (two passes for
DECIMAL(10,2)).

The path is the same at every size and the answer does not depend on
partitioning, so reruns agree. Values are handled as exact integers (a
decimal's unscaled value), so no rounding enters.
"""
from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ACCURACY = 10_000
BUCKETS = 1 << 18


def _rank(p: float, n: int) -> int:
    """Smallest k >= 1 with k / n >= p (the cumulative-distribution rule)."""
    k = max(1, min(n, math.ceil(p * n)))
    while k > 1 and (k - 1) / n >= p:
        k -= 1
    while k < n and k / n < p:
        k += 1
    return k


def _as_long(df: DataFrame, col: str) -> tuple[Column, int, tuple[int, int] | None]:
    """The column as exact integers, its decimal scale, and the type's range
    when the type bounds it tightly (decimals)."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.DecimalType):
        if dt.precision > 18:
            raise TypeError(f"{col}: decimals above precision 18 are not supported")
        bound = 10 ** dt.precision - 1
        return (F.col(col) * F.lit(10 ** dt.scale)).cast("long"), dt.scale, (-bound, bound)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(col).cast("long"), 0, None
    raise TypeError(f"{col}: exact percentile needs an integral or decimal column, got {dt}")


def exact_percentile_disc(df: DataFrame, col: str, p: float, *, buckets: int = BUCKETS):
    """Exact ``percentile_disc(p)`` of a decimal or integral column (NULLs
    ignored). Returns ``Decimal`` for decimals, ``int`` otherwise, ``None``
    when there is no value."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    v, scale, type_range = _as_long(df, col)
    x = df.select(v.alias("v")).where(F.col("v").isNotNull())
    n = None
    if type_range is not None:
        lo, hi = type_range
    else:
        lo, hi = x.agg(F.min("v"), F.max("v")).first()
        if lo is None:
            return None
    while True:
        w = 1 if lo == hi else -(-(hi - lo + 1) // buckets)
        cell = (F.when(F.col("v") < lo, F.lit(-1))
                 .when(F.col("v") > hi, F.lit(buckets))
                 .otherwise(F.floor((F.col("v") - F.lit(lo)) / F.lit(w)).cast("long")))
        hist = {r["b"]: r["c"] for r in
                x.groupBy(cell.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()}
        if n is None:
            n = sum(hist.values())
            if n == 0:
                return None
        k = _rank(p, n)
        cum = hist.get(-1, 0)
        for b in sorted(b for b in hist if 0 <= b < buckets):
            cum += hist[b]
            if cum >= k:
                break
        new_lo = lo + b * w
        if w == 1:
            return Decimal(new_lo).scaleb(-scale) if scale else new_lo
        lo, hi = new_lo, min(hi, new_lo + w - 1)


def approx_percentile(df: DataFrame, col: str, p: float, accuracy: int = DEFAULT_ACCURACY):
    """``percentile_approx`` in one sketch pass. The partial sketches of all
    map tasks are merged in one task: meant for inputs of moderate task
    counts."""
    return df.agg(F.percentile_approx(col, p, accuracy).alias("q")).first()["q"]


def ceiling(df: DataFrame, col: str, p: float, factor: Decimal, fallback: Decimal,
            mode: str = "exact", accuracy: int = DEFAULT_ACCURACY,
            relative_error: float = 0.01) -> Decimal:
    """``factor`` x the ``p`` percentile of ``col``; ``fallback`` when there is
    no value or the percentile is 0. Exact decimal arithmetic throughout.

    ``mode``: ``exact`` (default), ``approx`` (``percentile_approx`` at
    ``accuracy``), or ``stat`` (``DataFrame.approxQuantile`` at
    ``relative_error``: the sketch call of the original job, which may answer
    anything within 1% of the rank, the maximum included)."""
    if mode == "exact":
        q = exact_percentile_disc(df, col, p)
    elif mode == "approx":
        q = approx_percentile(df, col, p, accuracy)
    elif mode == "stat":
        got = df.approxQuantile(col, [p], relative_error)
        q = Decimal(repr(got[0])) if got else None
    else:
        raise ValueError(f"unknown ceiling mode {mode!r}")
    if q is None or q == 0:
        return Decimal(fallback)
    return Decimal(q) * Decimal(factor)
