"""Foreign-key checks against dimension tables.

The fact table is never shuffled for a check whose dimension fits a
broadcast: the dimension is counted first (``fits_broadcast``) and its key set
broadcast only below a fixed row bound. Above it the check is a sort-merge
left join, and a key holding a large share of the fact rows must be split
across tasks by AQE's skew-join handling. That handling needs both join
inputs to come straight from shuffles that the join itself requires; an
aggregate (the ``distinct``) directly under the join hides the key side's
shuffle from it. So above the bound the key set is first written as Parquet
under the checkpoint folder and read back: the join then plans its own
shuffles, and a hot fact key is split (the plan shows
``SortMergeJoin(skew=true)``).

That join is the last resort: before it, the fact's distinct keys (one narrow
column, pre-reduced in every map task) are compared with the dimension's. The
keys that are missing are few in most facts; counted below the bounds, these
are broadcast instead and the fact's rows are not shuffled.
"""
from __future__ import annotations

import uuid
import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.session import ensure_checkpoint_dir

# A key set is broadcast only when both bounds hold: at most this many rows,
# and at most this many bytes of values plus a fixed per-row overhead of the
# hashed relation.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48


def distinct_keys(dim: DataFrame, key: str, alias: str | None = None, trim: bool = True) -> DataFrame:
    """The non-NULL, trimmed, distinct keys of a dimension, one column."""
    k = F.trim(F.col(key)) if trim else F.col(key)
    name = alias or key
    return dim.select(k.alias(name)).where(F.col(name).isNotNull()).distinct()


def _value_bytes(df: DataFrame):
    sizes = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    out = sizes[0]
    for x in sizes[1:]:
        out = out + x
    return out.cast("long")


# Measurements per frame object (weakly held): a frame reused by several
# plans is counted once. A frame read again from storage is a new object
# and is measured again; a stale answer could only change the join strategy.
_MEASURED: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def fits_broadcast(df: DataFrame, max_rows: int,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                   columns: tuple[str, ...] | None = None) -> bool:
    """True when ``df`` (or its ``columns``) has at most ``max_rows`` rows and
    its values take at most ``max_bytes``. Counted, not estimated from file
    sizes, in one scan of the columns: every map task sends one row."""
    if max_rows <= 0:
        return False
    key = tuple(columns) if columns else None
    try:
        memo = _MEASURED.setdefault(df, {})
    except TypeError:  # not weak-referenceable
        memo = {}
    if key not in memo:
        probe = df.select(*columns) if columns else df
        r = probe.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(_value_bytes(probe)), F.lit(0).cast("long")).alias("b")).first()
        memo[key] = (r["n"], r["b"])
    n, b = memo[key]
    return n <= max_rows and b + ROW_OVERHEAD_BYTES * n <= max_bytes


def stage_keys(keys: DataFrame, stage_dir: str | None = None) -> DataFrame:
    """Write a key set under ``stage_dir`` (default: the checkpoint folder)
    and read it back: cuts its lineage and leaves no partitioning for the
    join to inherit. The caller owning ``stage_dir`` removes it."""
    spark = keys.sparkSession
    root = stage_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/verity-keys"
    path = f"{root.rstrip('/')}/keys-{uuid.uuid4().hex}"
    keys.write.parquet(path)
    return spark.read.schema(keys.schema).parquet(path)


def _maybe_broadcast(keys: DataFrame, max_rows: int, dim: DataFrame | None = None,
                     dim_key: str | None = None, stage: bool = False,
                     stage_dir: str | None = None) -> DataFrame:
    """Broadcast the key set when it is at most ``max_rows``. With the
    dimension given, its row count (an upper bound on its distinct keys) is
    checked instead: a single scan stage instead of an aggregation. Above the
    bound the key set is staged when ``stage`` (fact-row joins, see above)."""
    fits = (fits_broadcast(dim, max_rows, columns=(dim_key,)) if dim is not None
            else fits_broadcast(keys, max_rows))
    if fits:
        return F.broadcast(keys)
    return stage_keys(keys, stage_dir) if stage else keys


def check_reference(df: DataFrame, col: str, dim: DataFrame, dim_key: str | None = None,
                    flag: str | None = None,
                    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                    stage_dir: str | None = None) -> DataFrame:
    """Add boolean ``flag`` (default ``valid_<col>_ref``): the value of
    ``col`` exists among the dimension's keys. Joins against the distinct key
    set, so a row is never multiplied."""
    flag = flag or f"valid_{col}_ref"
    probe, lacking = f"__known_{col}", f"__unknown_{col}"
    keys = _maybe_broadcast(distinct_keys(dim, dim_key or col, probe), broadcast_max_rows,
                            dim, dim_key or col, stage=True, stage_dir=stage_dir)
    if 0 < broadcast_max_rows and not fits_broadcast(dim, broadcast_max_rows, columns=(dim_key or col,)):
        unknown = stage_keys(_unknown_keys(df, col, keys, probe, lacking), stage_dir)
        if fits_broadcast(unknown, broadcast_max_rows):
            joined = df.join(F.broadcast(unknown), F.col(col) == F.col(lacking), "left")
            return joined.withColumn(flag, F.col(col).isNotNull() & F.col(lacking).isNull()).drop(lacking)
    joined = df.join(keys, F.col(col) == F.col(probe), "left")
    return joined.withColumn(flag, F.col(probe).isNotNull()).drop(probe)


def _unknown_keys(df: DataFrame, col: str, keys: DataFrame, probe: str, name: str) -> DataFrame:
    """The distinct non-NULL values of ``col`` that are not among ``keys``. A
    left join, as in ``orphans``."""
    asked = df.select(F.col(col).alias(name)).where(F.col(name).isNotNull()).distinct()
    return asked.join(keys, F.col(name) == F.col(probe), "left").where(F.col(probe).isNull()).select(name)


def orphans(df: DataFrame, checks: dict[str, tuple[str, DataFrame, str]],
            broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Keys of the fact table missing from their dimension.

    ``checks`` maps a side name to ``(fact_col, dim, dim_key)``. Output: side,
    key, rows. NULL and blank keys are missing values, not orphans, and are
    left out. The fact side is aggregated per key before the anti join, so
    only one row per distinct key reaches it.
    """
    parts = []
    for side, (col, dim, dim_key) in checks.items():
        per_key = (df.select(F.trim(F.col(col)).alias("key"))
                     .where(F.col("key").isNotNull() & (F.col("key") != ""))
                     .groupBy("key").agg(F.count(F.lit(1)).alias("rows")))
        known = _maybe_broadcast(distinct_keys(dim, dim_key, "__known"), broadcast_max_rows,
                                 dim, dim_key)
        # A left join with an IS NULL filter rather than a left anti join:
        # Catalyst pushes anti joins below an aggregate on the join key, which
        # would make the join see every fact row instead of one per key.
        parts.append(per_key.join(known, F.col("key") == F.col("__known"), "left")
                     .where(F.col("__known").isNull())
                     .select(F.lit(side).alias("side"), "key", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

