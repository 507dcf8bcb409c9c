"""A3 kept up to date: exact percentiles from stored value counts.

``value_counts`` reduces a column to its distinct values (as exact integers)
with their counts, per day or per run. Such tables are mergeable: replacing a
day replaces its folder, and counts of several days add up. A percentile is
then found from the counts alone, without the rows behind them.

``percentile_of`` is one lazy plan. Values are placed in nested cells of
``BUCKETS`` each; per level, the counts of the current cell's parts are added
up (at most ``BUCKETS`` rows, over which the running sum is taken), and the
part where it passes the rank is joined back by cell to the next level. So no
single task sees more rows than a level has cells, however many values there
are.
"""
from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.operators.quantile import BUCKETS
from verity.sinks.writers import Written, write_partitioned


def _whole(df: DataFrame, col: str) -> tuple[Column, int]:
    """The column as exact integers, and its decimal scale."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.DecimalType) and dt.precision <= 18:
        return (F.col(col) * F.lit(10 ** dt.scale)).cast("long"), dt.scale
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(col).cast("long"), 0
    raise TypeError(f"{col}: exact counts need an integral column or a decimal of at most 18 digits, got {dt}")


def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """``v`` (unscaled), ``n`` and ``scale`` per distinct non-null value, per
    ``by``. Pre-aggregated in every map task."""
    v, scale = _whole(df, col)
    return (df.select(v.alias("v"), *by).where("v IS NOT NULL").groupBy("v", *by)
            .agg(F.count(F.lit(1)).alias("n")).select("v", "n", F.lit(scale).alias("scale"), *by))


def write_value_counts(df: DataFrame, path: str, col: str, by: Sequence[str]) -> Written:
    """Replace the counts of the partitions (values of ``by``) in ``df``, each
    of which must be whole."""
    return write_partitioned(value_counts(df, col, by), path, by)


def read_value_counts(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    return spark.read.schema("v long, n long, scale int, " + ", ".join(f"`{c}` string" for c in by)).parquet(path)


def _rank(p: float, n: Column) -> Column:
    """Smallest k >= 1 with k / n >= p."""
    k = F.ceil(F.lit(float(p)) * n)
    k = F.when((k - 1) / n >= F.lit(float(p)), k - 1).when(k / n < F.lit(float(p)), k + 1).otherwise(k)
    return F.greatest(k.cast("long"), F.lit(1).cast("long"))


def percentile_of(counts: DataFrame, p: float, digits: int = 18, buckets: int = BUCKETS) -> DataFrame:
    """One row ``percentile`` (DECIMAL(38,18), NULL without values): the
    exact ``percentile_disc(p)`` of counted values (``v``, ``n``, ``scale``).
    ``digits``: of the unscaled values at most (a decimal's precision); fewer
    digits, fewer levels."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    widths = [1]
    while widths[0] * buckets < min(10 ** digits, 1 << 63):
        widths.insert(0, widths[0] * buckets)
    found = None  # the cell of the level before, the count below it, and the rank
    for i, width in enumerate(widths):
        cells = counts.select(_cell(F.col("v"), width).alias("cell"), "n", "scale")
        if found is not None:
            outer = widths[i - 1] // width
            cells = (cells.withColumn("outer", _cell(F.col("cell"), outer))
                     .join(F.broadcast(found), "outer"))  # one row
        else:
            cells = cells.withColumns({"below": F.lit(0).cast("long"), "k": F.lit(None).cast("long")})
        sums = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.max("scale").alias("scale"),
                                         F.max("below").alias("below"), F.max("k").alias("k"))
        upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumns({"upto": F.col("below") + F.sum("n").over(upto),
                                 "total": F.sum("n").over(Window.partitionBy())})
        sums = sums.withColumn("k", F.coalesce("k", _rank(p, F.col("total"))))
        hit = sums.where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k")))
        found = hit.select(F.col("cell").alias("outer"), (F.col("upto") - F.col("n")).alias("below"), "k",
                           F.col("scale").alias("digits"))
    value = F.col("outer").cast("decimal(38,18)") / F.pow(F.lit(10), F.col("digits")).cast("decimal(20,0)")
    return found.agg(F.max(value).cast("decimal(38,18)").alias("percentile"))


def _cell(x: Column, width: int) -> Column:
    """Floor of the exact integer quotient."""
    w = F.lit(width).cast("long")
    return F.call_function("div", x - F.pmod(x, w), w)


def ceiling_of(counts: DataFrame, p: float, factor: Decimal, fallback: Decimal, digits: int = 18) -> DataFrame:
    """One row ``ceiling`` (DECIMAL(38,6)): ``factor`` times the percentile of
    counted values; ``fallback`` when there is none or it is 0."""
    q = F.nullif(F.col("percentile").cast("decimal(20,4)"), F.lit(0).cast("decimal(20,4)"))
    return percentile_of(counts, p, digits).select(
        F.coalesce((q * F.lit(Decimal(factor))).cast("decimal(38,6)"), F.lit(Decimal(fallback)).cast("decimal(38,6)"))
        .alias("ceiling"))
