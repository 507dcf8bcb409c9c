"""U1 through the writers: proof that a run can be repeated.

The batch is run, the digests of what it stored are kept, the same batch is
run again, and the digests are taken anew. Days and runs whose digests agree
are equal; where they do not, the rows are compared and an error names the
tables and counts. Between the runs only digests are held, not a copy of the
tables: the first run's rows of a differing day are gone by then, so the error
counts rows by digest bucket.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity import constants as K
from verity import schemas
from verity.operators.digest import differing, read_digests, write_digests
from verity.plans.job import BatchPaths, run_batch
from verity.session import ensure_checkpoint_dir, remove_path
from verity.sources.curated import read_curated, read_rejected

TABLES = {
    "curated.transactions": (read_curated, "curated", K.PARTITION_COLUMNS, schemas.CURATED_TRANSACTIONS),
    "rejected.transactions": (read_rejected, "rejected", ("run_id",), schemas.REJECTED_TRANSACTIONS),
}


class RerunDifference(AssertionError):
    """The same batch, run twice, stored different rows."""


def rerun_proof(spark: SparkSession, paths: BatchPaths, run_id: str, config=None, **batch_options) -> DataFrame:
    """Run a batch twice. Returns ``table_name``, ``n_rows`` and ``identical``
    (true) for each table of facts; raises ``RerunDifference`` if the second
    run left other rows than the first. ``batch_options`` go to ``run_batch``
    (but ``release``: the tables are read by path)."""
    if batch_options.get("release"):
        raise ValueError("a rerun proof reads the tables by path")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/verity-proof/{uuid.uuid4().hex}"
    try:
        for attempt in ("first", "second"):
            run_batch(spark, paths, run_id, config, **batch_options)
            for name, (read, place, by, schema) in TABLES.items():
                write_digests(read(spark, getattr(paths, place)), f"{root}/{attempt}/{name}", by, schemas.names(schema))
        rows, wrong = [], []
        for name, (_, _, by, _) in TABLES.items():
            one, two = (read_digests(spark, f"{root}/{attempt}/{name}", by) for attempt in ("first", "second"))
            diff = differing(one, two, by).agg(F.count(F.lit(1)).alias("n"), F.sum("rows_a").alias("a"),
                                               F.sum("rows_b").alias("b")).first()
            if diff.n:
                wrong.append(f"{name}: {diff.n} buckets differ, {diff.a} rows in the first run, {diff.b} in the second")
            rows.append((name, two.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0], not diff.n))
        if wrong:
            raise RerunDifference(f"run {run_id}: " + "; ".join(wrong))
        return spark.createDataFrame(rows, "table_name string, n_rows long, identical boolean")
    finally:
        remove_path(spark, root)
