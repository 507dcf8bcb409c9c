"""The stage-1 batch job and the stage-2 publish.

Scans the raw transactions once: the checked frame (typed rows with their
reference flags) is written once as a staging table under the checkpoint
folder (or persisted), and the ceiling passes, the counts and both writes
read it. The raw and rejected counts are one aggregate over a few of its
columns; the curated count and the written partitions are observed by the
writes themselves.
"""
from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity import constants as K
from verity import schemas
from verity.operators.dedupe import dedupe
from verity.operators.histogram import ceiling_of, read_value_counts, write_value_counts
from verity.operators.id_index import add_to_index, build_index, has_index, lookup, read_index
from verity.plans.pipeline import (
    DEDUPE_TIE_BREAK, CurationConfig, CurationResult, amount_ceiling, check_references, clean_and_curate,
    standardize,
)
from verity.plans.rollups import ROLLUPS, rollup_path, write_rollups
from verity.session import (
    ensure_checkpoint_dir, input_bytes, path_exists, remove_path, session_settings, size_shuffles, versions_root,
)
from verity.sinks.catalog import (
    add_partitions, create_tables, define_table, drop_partitions, repair_partitions,
)
from verity.sinks.release import Release, finish_pending
from verity.sinks.writers import (
    Written, metrics_frame, publish_dimension, publish_frame, run_folder, write_curated, write_rejected,
    write_run_metrics,
)
from verity.sources.curated import read_curated
from verity.sources.raw import read_raw_csv

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchPaths:
    raw_transactions: str
    raw_customers: str
    raw_products: str
    curated: str
    rejected: str
    metrics: str
    customers: str
    products: str

    @classmethod
    def under(cls, raw_root: str, out_root: str) -> "BatchPaths":
        r, o = raw_root.rstrip("/"), out_root.rstrip("/")
        return cls(f"{r}/transactions", f"{r}/customers", f"{r}/products",
                   f"{o}/curated/transactions", f"{o}/rejected/transactions",
                   f"{o}/control/run_metrics", f"{o}/curated/customers", f"{o}/curated/products")

    @property
    def index(self) -> str:
        """Which days hold an id (kept once a merge has asked for it)."""
        return f"{self.curated.rstrip('/')}.index"

    @property
    def daily(self) -> str:
        """Per-day rollups (kept once a batch has asked for them)."""
        return f"{self.curated.rstrip('/')}.daily"

    @property
    def amounts(self) -> str:
        """Value counts of every run's amounts (for ``ceiling_scope="history"``)."""
        return f"{self.curated.rstrip('/')}.amounts"

    @property
    def releases(self) -> str:
        """Records of runs published as a whole."""
        return f"{self.metrics.rstrip('/')}.releases"


# A shuffle partition of this much raw text (about 400,000 rows) is sorted in
# memory, and holds few enough days that a split of it leaves few small files.
BATCH_TARGET_BYTES = 32 * 1024 * 1024
TARGET_PARTITIONS = 4096
# Raw text to Parquet of the same rows, about.
PARQUET_WEIGHT = 3


def size_batch(spark: SparkSession, text_bytes: int | None) -> int:
    """Shuffle partitions for a batch of so many bytes of text: 32 MB each up
    to 4,096 partitions, then larger ones up to 256 MB."""
    target = max(BATCH_TARGET_BYTES, min(8 * BATCH_TARGET_BYTES, (text_bytes or 0) // TARGET_PARTITIONS))
    return size_shuffles(spark, text_bytes, target)


def staging_root(spark: SparkSession, run_id: str) -> str:
    """A scratch folder under the checkpoint folder for one attempt of a run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/verity-staging/{uuid.uuid4().hex}"


def _day_path(path: str, day: dict[str, str]) -> str:
    return f"{path.rstrip('/')}/" + "/".join(f"{c}={day[c]}" for c in K.PARTITION_COLUMNS)


def _day_name():
    return F.concat_ws("-", *K.PARTITION_COLUMNS)


def _of_days(table: DataFrame, days) -> DataFrame:
    """The rows of some days. A predicate on partition columns only: resolved
    against the partitions' names, so only these days are listed and read."""
    return table.where(_day_name().isin(sorted(days)))


def merge_existing(batch: DataFrame, stored: DataFrame, staging_dir: str, config: CurationConfig,
                   scope: str = "days", index_root: str | None = None) -> tuple[DataFrame, list[dict[str, str]]]:
    """Fold stored rows into the batch, so that replacing the batch's days
    keeps them (B10). ``batch`` should be cheap to read again (staged).

    ``scope="days"``: the stored rows of the batch's own days. ``"table"``:
    also those of the days holding an older copy of one of the batch's ids, so
    an id whose date changed keeps one copy. These days come from the id index
    at ``index_root``: only the buckets of the batch's ids are read, never the
    table's own ids. Returns the rows to write and the days left without rows,
    which the caller removes after the write has succeeded.

    The affected days are bounded by the calendar. The merged rows are
    deduplicated with the batch order and written to ``staging_dir`` before
    the target is touched, so the job never overwrites what it is reading and
    a failure leaves the target as it was.
    """
    spark = batch.sparkSession
    days = {r[0] for r in batch.select(_day_name()).distinct().collect()}
    if not days:
        return batch, []
    if scope == "table":
        held = lookup(read_index(spark, index_root), batch, "transaction_id",
                      broadcast_max_rows=config.broadcast_max_rows)
        days |= {r.day for r in held.select("day").distinct().collect()}
    both = batch.unionByName(_of_days(stored, days).select(*batch.columns))
    merged = dedupe(both, list(config.dedupe_keys),
                    [F.col("ingestion_timestamp").desc_nulls_last(),
                     F.col("source_file").asc_nulls_first()],
                    tie_break=list(DEDUPE_TIE_BREAK) + ["run_id"])
    written = Written(K.PARTITION_COLUMNS)
    written.of(merged).write.mode("overwrite").parquet(f"{staging_dir}/merged")
    kept = {"-".join(day.values()) for day in written.partitions()}
    # Every row of these days moved to another day, or none was there.
    emptied = [dict(zip(K.PARTITION_COLUMNS, day.split("-"))) for day in sorted(days - kept)]
    return spark.read.schema(schemas.CURATED_TRANSACTIONS).parquet(f"{staging_dir}/merged"), emptied


def run_batch(spark: SparkSession, paths: BatchPaths, run_id: str,
              config: CurationConfig | None = None, *, register: bool = True,
              merge: bool = False, merge_scope: str = "days", publish: bool = True,
              transactions: DataFrame | None = None, materialize: str = "staged",
              storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK, release: bool = False,
              rollups: bool = False, curated_db: str = "curated", rejected_db: str = "rejected") -> dict:
    """Read, clean, validate, dedupe and write one batch; record its counts;
    republish the dimensions; define the tables and register what was written.

    The checked frame is computed once and read by every later step:
    ``materialize="staged"`` (default) writes it as Parquet under the
    session's checkpoint folder, which cuts the lineage, survives lost
    executors without recomputation, and lets the ceiling passes read the
    amount column alone; ``"persist"`` keeps it in executor memory and disk
    instead. ``transactions`` may be given instead of the raw path (the
    streaming ingest passes each micro-batch).

    ``release=True`` publishes the run as a whole: every output goes into
    fresh folders, and the catalog points to them only after the last write
    (see ``verity.sinks.release``); readers go through the catalog. Tables
    once published so refuse runs that are not. ``rollups=True`` keeps per-day
    totals of the curated rows (see ``verity.plans.rollups``); once there,
    every run keeps them. Returns the counts.
    """
    config = config or CurationConfig()
    if merge_scope not in ("days", "table"):
        raise ValueError(f"unknown merge scope {merge_scope!r}")
    if materialize not in ("staged", "persist"):
        raise ValueError(f"unknown materialize mode {materialize!r}")
    if config.ceiling_scope not in ("batch", "history"):
        raise ValueError(f"unknown ceiling scope {config.ceiling_scope!r}")
    if release and not register:
        raise ValueError("a release is published through the catalog")
    if not release and path_exists(spark, paths.releases):
        raise ValueError(f"{paths.releases} exists: these tables are published by releases")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions", "200")
    # Text is read as UTC whatever the caller's zone; the caller's settings
    # come back at the end.
    scratch = staging_root(spark, run_id)
    with session_settings(spark, spark__sql__session__timeZone="UTC",
                          spark__sql__legacy__timeParserPolicy="CORRECTED",
                          spark__sql__shuffle__partitions=shuffles,
                          # By bytes alone a small batch over many days would be
                          # coalesced into one task that writes every day's file.
                          spark__sql__adaptive__coalescePartitions__enabled="false"):
        try:
            if transactions is None:
                # Shuffle partitions sized from the raw input (only ever raised).
                size_batch(spark, input_bytes(spark, paths.raw_transactions))
                transactions = read_raw_csv(spark, paths.raw_transactions, schemas.RAW_TRANSACTIONS)
            customers = read_raw_csv(spark, paths.raw_customers, schemas.RAW_CUSTOMERS)
            products = read_raw_csv(spark, paths.raw_products, schemas.RAW_PRODUCTS)
            checked = check_references(standardize(transactions, config), customers, products, config,
                                       stage_dir=f"{scratch}/keys")
            if materialize == "staged":
                checked.write.mode("overwrite").parquet(f"{scratch}/checked")
                checked = spark.read.schema(checked.schema).parquet(f"{scratch}/checked")
                # Known only now if the landing is compressed, or rows were given.
                size_batch(spark, PARQUET_WEIGHT * (input_bytes(spark, f"{scratch}/checked") or 0))
            else:
                checked = checked.persist(storage_level)
            try:
                ceiling = amount_ceiling(checked, config) if config.ceiling_scope == "batch" \
                    else _history_ceiling(checked, paths.amounts, run_id, config)
                result = clean_and_curate(transactions, customers, products, run_id, config=config,
                                          ceiling=ceiling, checked=checked)
                dimensions = {}
                if publish:
                    dimensions = {"customers": (customers, schemas.CURATED_CUSTOMERS, "customer_id", paths.customers),
                                  "products": (products, schemas.CURATED_PRODUCTS, "product_id", paths.products)}
                batch = _Batch(spark, paths, run_id, config, result, scratch, merge, merge_scope, rollups,
                               curated_db, rejected_db)
                counts = batch.publish(dimensions) if release else batch.write(dimensions, register)
            finally:
                checked.unpersist()
        finally:
            remove_path(spark, scratch)
    log.warning("[run=%s] raw_count=%s rejected_count=%s curated_count=%s", run_id,
                counts["raw_count"], counts["rejected_count"], counts["curated_count"])
    return counts


def _history_ceiling(checked: DataFrame, path: str, run_id: str, config: CurationConfig) -> Decimal:
    """The ceiling over the amounts of every run so far, this one included: a
    run's value counts replace what it left before, and the percentile is
    found in the counts; no earlier run's rows are read."""
    spark, by = checked.sparkSession, ("run_id",)
    mine = checked.select("amount", F.lit(run_id).alias("run_id"))
    if not write_value_counts(mine, path, "amount", by).partitions():
        remove_path(spark, run_folder(spark, path, run_id))
    counts = read_value_counts(spark, path, by)
    found = ceiling_of(counts, config.ceiling_percentile, config.ceiling_factor, config.ceiling_fallback,
                       schemas.MONEY.precision)
    return found.first()["ceiling"]


@dataclass
class _Batch:
    """The output side of one run."""
    spark: SparkSession
    paths: BatchPaths
    run_id: str
    config: CurationConfig
    result: CurationResult
    scratch: str
    merge: bool
    merge_scope: str
    rollups: bool
    curated_db: str
    rejected_db: str

    def table(self, name: str) -> str:
        return f"{self.curated_db}.{name}"

    def tables(self) -> dict[str, bool]:
        p = self.paths
        return create_tables(self.spark, p.curated, p.rejected, p.metrics, p.customers, p.products,
                             self.curated_db, self.rejected_db)

    def keeps_rollups(self) -> bool:
        """Asked for now, or kept since an earlier run."""
        return self.rollups or path_exists(self.spark, self.paths.daily)

    def folded(self, stored: DataFrame | None) -> tuple[DataFrame, list[dict[str, str]], Written | None]:
        """The rows to write, the days they leave empty, and what the staged
        batch held. A merge reads the deduplicated batch several times (days,
        ids, rows), so it is staged first."""
        spark, root = self.spark, self.paths.index
        by_id = self.merge and self.merge_scope == "table"
        if not by_id and not self.merge and not has_index(spark, root):
            return self.result.curated, [], None
        staged = Written()
        staged.of(self.result.curated).write.mode("overwrite").parquet(f"{self.scratch}/batch")
        batch = spark.read.schema(schemas.CURATED_TRANSACTIONS).parquet(f"{self.scratch}/batch")
        # A small batch may meet a large table: the partitions are sized from
        # what is stored, and those of a few days are coalesced again.
        with session_settings(spark, spark__sql__shuffle__partitions=spark.conf.get("spark.sql.shuffle.partitions"),
                              spark__sql__adaptive__coalescePartitions__enabled="true"):
            size_batch(spark, self.stored_bytes())
            if by_id and stored is not None and not has_index(spark, root):
                build_index(stored, root, "transaction_id", K.PARTITION_COLUMNS)
            if by_id or has_index(spark, root):
                # Before the table: the index may know too much, never too little.
                add_to_index(batch, root, "transaction_id", K.PARTITION_COLUMNS, self.run_id)
            if not self.merge or stored is None:
                return batch, [], staged
            rows, emptied = merge_existing(batch, stored, self.scratch, self.config, self.merge_scope, root)
        # The write deals the merged rows, not the batch, to its tasks.
        size_batch(spark, PARQUET_WEIGHT * (input_bytes(spark, f"{self.scratch}/merged") or 0))
        return rows, emptied, staged

    def stored_bytes(self) -> int:
        """The text that the stored facts are about as large as."""
        places = (self.paths.curated, versions_root(self.paths.curated))
        return PARQUET_WEIGHT * sum(input_bytes(self.spark, p) or 0 for p in places)

    def counts(self) -> dict:
        # Raw, rejected and distinct valid counts: one aggregate over the
        # checked rows.
        tally = self.result.funnel().first()
        return {"run_id": self.run_id, "raw_count": tally["raw_count"], "rejected_count": tally["rejected_count"],
                "curated_count": None, "duplicates_dropped": tally["duplicates_dropped"],
                "ceiling": str(self.result.ceiling)}

    def write(self, dimensions: dict, register: bool) -> dict:
        """Write over the tables' own paths."""
        spark, paths = self.spark, self.paths
        stored = read_curated(spark, paths.curated) if path_exists(spark, paths.curated) else None
        counts = self.counts()
        rows, emptied, staged = self.folded(stored)
        # Independent jobs: submitted together.
        rejected, curated = concurrently(
            lambda: write_rejected(self.result.rejected, paths.rejected, self.run_id),
            lambda: write_curated(rows, paths.curated))
        for day in emptied:  # only after the write has succeeded
            remove_path(spark, _day_path(paths.curated, day))
        counts["curated_count"] = (staged or curated).rows()
        days = curated.partitions()
        if self.keeps_rollups():
            first = not path_exists(spark, paths.daily)
            if first:
                size_batch(spark, self.stored_bytes())
            facts = read_curated(spark, paths.curated)
            write_rollups(facts if first else _of_days(facts, ["-".join(d.values()) for d in days]), paths.daily)
            for name in ROLLUPS:
                for day in emptied:
                    remove_path(spark, _day_path(rollup_path(paths.daily, name), day))
        jobs = [lambda: write_run_metrics(spark, counts, K.STAGE_CLEAN_AND_CURATE, paths.metrics, self.run_id)]
        jobs += [lambda d=d: publish_dimension(*d) for d in dimensions.values()]
        concurrently(*jobs)
        if register:
            self.register(days, emptied, rejected.partitions())
        return counts

    def register(self, days: list, emptied: list, rejected: list) -> None:
        """Make the written partitions known. Only a table that is new to the
        catalog is searched for the partitions of earlier runs."""
        spark = self.spark
        metrics = [{"run_id": self.run_id, "stage": K.STAGE_CLEAN_AND_CURATE}]
        defined = self.tables()
        for name, parts in zip(defined, (days, rejected, metrics)):
            if defined[name]:
                repair_partitions(spark, name)
            else:
                add_partitions(spark, name, parts)
                spark.catalog.refreshTable(name)
        drop_partitions(spark, self.table("transactions"), emptied)
        for name in ("customers", "products"):
            spark.catalog.refreshTable(self.table(name))

    def publish(self, dimensions: dict) -> dict:
        """Write aside, then point the catalog to all of it (see ``Release``)."""
        spark, paths = self.spark, self.paths
        defined = self.tables()
        repair_partitions(spark, *[name for name, fresh in defined.items() if fresh])
        finish_pending(spark, paths.releases)
        facts, rejects = self.table("transactions"), f"{self.rejected_db}.transactions"
        counts = self.counts()
        rows, emptied, staged = self.folded(spark.table(facts))
        release = Release(spark, paths.releases)
        try:
            rejected, curated = concurrently(
                lambda: release.write_partitions(self.result.rejected, rejects, paths.rejected, ("run_id",), ()),
                lambda: release.write_partitions(rows, facts, paths.curated, K.PARTITION_COLUMNS))
            counts["curated_count"] = (staged or curated).rows()
            if not rejected.partitions():
                release.drop(rejects, {"run_id": self.run_id})
            for day in emptied:
                release.drop(facts, day)
            if self.keeps_rollups():
                self.publish_rollups(release, curated.partitions(), emptied)
            metrics = metrics_frame(spark, counts, K.STAGE_CLEAN_AND_CURATE, self.run_id)
            jobs = [lambda: release.write_partitions(metrics, self.table("run_metrics"), paths.metrics,
                                                     ("run_id", "stage"), ())]
            jobs += [lambda n=n, d=d: release.write_table(publish_frame(*d[:3]), self.table(n), d[3])
                     for n, d in dimensions.items()]
            concurrently(*jobs)
            release.commit()
        finally:
            release.abandon()
        return counts

    def publish_rollups(self, release: Release, days: list, emptied: list) -> None:
        """Totals of the days just written; of every day the first time."""
        spark, paths = self.spark, self.paths
        batch = spark.read.schema(schemas.CURATED_TRANSACTIONS).parquet(release.folder_of(paths.curated))
        jobs = []
        for name, (schema, totals) in ROLLUPS.items():
            table, path = self.table(name), rollup_path(paths.daily, name)
            fresh = totals(batch)
            if define_table(spark, table, schema, path, K.PARTITION_COLUMNS):
                size_batch(spark, self.stored_bytes())
                # The table still shows the days as they were before this run.
                changed = sorted("-".join(d.values()) for d in [*days, *emptied])
                others = spark.table(self.table("transactions")).where(~_day_name().isin(changed))
                fresh = fresh.unionByName(totals(others))
            jobs.append(lambda f=fresh, t=table, p=path: release.write_partitions(f, t, p, K.PARTITION_COLUMNS))
            for day in emptied:
                release.drop(table, day)
        concurrently(*jobs)


def concurrently(*actions) -> list:
    """Run independent Spark actions from separate driver threads, so their
    jobs share the executors instead of waiting for each other. Waits for all
    of them, re-raises the first failure, and returns their results in order;
    every writer here is rerun-safe, so a failed run is simply run again."""
    if len(actions) == 1:
        return [actions[0]()]
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        for other in errors[1:]:
            errors[0].add_note(f"failed as well: {other!r}")
        raise errors[0]
    return [f.result() for f in futures]


def publish_catalog(spark: SparkSession, paths: BatchPaths, curated_db: str = "curated",
                    rejected_db: str = "rejected", tables: tuple[str, ...] | None = None) -> None:
    """Stage 2: define the tables (idempotent) and repair the partitions of
    the partitioned ones, the rejected one included (B16), or of ``tables``."""
    if path_exists(spark, paths.releases):
        finish_pending(spark, paths.releases)
    parts = create_tables(spark, paths.curated, paths.rejected, paths.metrics,
                          paths.customers, paths.products, curated_db, rejected_db)
    repair_partitions(spark, *(tables or parts))
