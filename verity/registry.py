"""Registered queries over the fixture tables, one per operator key.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole fixture (derived from every row of ``lineitem`` and ``orders``). Keys
over validated rows compute the amount ceiling while the frame is built; those
over stored outputs run the batch job first, once per session and folder. Money
leaves as DOUBLE after exact decimal work; counts are BIGINT.
"""
from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity import constants as K
from verity import schemas
from verity.functions.imputation import impute
from verity.functions.names import standardize_column_names
from verity.functions.predicates import date_in_range
from verity.functions.parsing import parse_amount, parse_date, parse_timestamp, partition_columns
from verity.operators.compare import compare_outputs, fingerprint
from verity.operators.conform import conform
from verity.operators.digest import compare_by_digest, read_digests, write_digests
from verity.operators.file_profile import file_profile
from verity.operators.histogram import ceiling_of, read_value_counts, value_counts, write_value_counts
from verity.operators.profile import schema_profile
from verity.operators.references import orphans
from verity.plans import analytics as A
from verity.plans import rollups as R
from verity.plans.job import BatchPaths, concurrently, publish_catalog, run_batch
from verity.plans.proof import rerun_proof
from verity.plans.pipeline import (
    CurationConfig, CurationResult, check_references, clean_and_curate, standardize,
)
from verity.session import ensure_checkpoint_dir, input_bytes, session_settings, size_shuffles
from verity.sinks.writers import publish_frame, write_curated
from verity.sources.curated import read_curated, read_rejected, read_run_metrics
from verity.sources.fixtures import FIXTURE_MAX_DATE, FIXTURE_MIN_DATE
from verity.sources.fixtures import fixture_tables as _fixture_tables

RUN_ID = "fixture"
HALF_DATE = "1998-06-30"  # splits the fixture's dates for ``run_difference``
FIXTURE_CONFIG = CurationConfig(min_date=FIXTURE_MIN_DATE, max_date=FIXTURE_MAX_DATE)
# Messy headers for the name-standardisation check, in raw column order.
MESSY_HEADERS = [" Transaction ID ", "Customer-Id", "PRODUCT_ID", "Transaction Date",
                 " Amount", "Quantity ", "Promo-Code", "Ingestion Timestamp", "Source File"]


def _prepare(spark: SparkSession) -> None:
    # Text <-> timestamp conversions in the fixture and the oracle are in UTC,
    # and date text is parsed strictly (a lenient parser would turn
    # 2019-13-40 into a real date).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "CORRECTED")


_FIXTURE_PLANS: dict = {}
# A shuffle partition for so much of the stored ``lineitem``: its rows, some
# 330,000, take twenty to thirty times that in a sort, which stays in memory.
FIXTURE_TARGET_BYTES = 4 * 1024 * 1024


def fixture_tables(spark: SparkSession, sf_dir: str):
    """The fixture frames of a session and folder, built once: a frame is a
    plan, and resolving six Parquet schemas per query costs more than many of
    the queries themselves. The test tables are read-only."""
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _FIXTURE_PLANS:
        _FIXTURE_PLANS[key] = (_fixture_tables(spark, sf_dir),
                               input_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    tables, nbytes = _FIXTURE_PLANS[key]
    size_shuffles(spark, nbytes, FIXTURE_TARGET_BYTES)  # AQE coalesces small ones
    return tables


def _run(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> CurationResult:
    """The pipeline over the fixture, shaped like ``run_batch``: the checked
    frame (typed rows and reference flags) is staged as Parquet, so the
    ceiling passes read the amounts alone and the query its columns, and no
    executor memory is held. Queries over the same inputs share it."""
    _prepare(spark)
    t, c, p = fixture_tables(spark, sf_dir)
    txns = raw if raw is not None else t
    checked = _shared(spark, sf_dir) if raw is None else \
        _staged(check_references(standardize(txns, FIXTURE_CONFIG), c, p, FIXTURE_CONFIG))
    return clean_and_curate(txns, c, p, RUN_ID, config=FIXTURE_CONFIG, checked=checked)


def _staged(df: DataFrame) -> DataFrame:
    """The frame written once under the checkpoint folder, and read back."""
    path = _folder(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged checked frame that the queries of a session share."""
    return _once(spark, sf_dir, "checked", lambda: _staged(_checked(spark, sf_dir)))


def _money_out(df: DataFrame, cols=("amount",)) -> DataFrame:
    """Output representation for the oracle comparison: money as DOUBLE and
    timestamps as wall-clock values without a zone (what SQL ``TIMESTAMP``
    is); the library itself keeps decimal and zoned timestamps."""
    out = df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})
    return _wall_clock(out)


def _wall_clock(df: DataFrame) -> DataFrame:
    ts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts}) if ts else df


def _published(spark: SparkSession, sf_dir: str):
    """The published dimension frames, built once per session and folder
    like the fixture frames they derive from."""
    _prepare(spark)
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir, "published")
    if key not in _FIXTURE_PLANS:
        _, c, p = fixture_tables(spark, sf_dir)
        _FIXTURE_PLANS[key] = (publish_frame(c, schemas.CURATED_CUSTOMERS, "customer_id"),
                               publish_frame(p, schemas.CURATED_PRODUCTS, "product_id"))
    return _FIXTURE_PLANS[key]


def _published_customers(spark, sf_dir):
    return _published(spark, sf_dir)[0]


def _published_products(spark, sf_dir):
    return _published(spark, sf_dir)[1]


def _raw(spark, sf_dir):
    _prepare(spark)
    return fixture_tables(spark, sf_dir)[0]


# --- operator keys --------------------------------------------------------

def q_schema_profile(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return schema_profile(raw, declared=schemas.RAW_TRANSACTIONS)


def q_publish_customers(spark, sf_dir):
    return _published_customers(spark, sf_dir)


def q_publish_products(spark, sf_dir):
    return _money_out(_published_products(spark, sf_dir), ("unit_price",))


def q_standardize_names(spark, sf_dir):
    return standardize_column_names(_raw(spark, sf_dir).toDF(*MESSY_HEADERS))


def q_parse_amount(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "transaction_id", F.col("amount").alias("amount_raw"),
        parse_amount("amount").cast("double").alias("amount"))


def q_parse_date(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "transaction_id", F.col("transaction_date").alias("transaction_date_raw"),
        parse_date("transaction_date").alias("transaction_date"))


def q_parse_timestamp(spark, sf_dir):
    return _wall_clock(_raw(spark, sf_dir).select(
        "transaction_id", F.col("ingestion_timestamp").alias("ingestion_timestamp_raw"),
        parse_timestamp("ingestion_timestamp").alias("ingestion_timestamp")))


def q_trim_ids(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    ids = ("transaction_id", "customer_id", "product_id")
    return raw.select(*[F.col(c).alias(f"{c}_raw") for c in ids],
                      *[F.trim(F.col(c)).alias(c) for c in ids])


def q_impute_promo(spark, sf_dir):
    value, imputed = impute("promo_code", K.PROMO_DEFAULT)
    return _raw(spark, sf_dir).select(
        "transaction_id", F.col("promo_code").alias("promo_code_raw"),
        value.alias("promo_code"), imputed.alias("is_imputed"))


def q_partition_columns(spark, sf_dir):
    return _typed(spark, sf_dir).select("transaction_id", "transaction_date",
                                        *partition_columns("transaction_date"))


def q_conform_types(spark, sf_dir):
    # The landing zone delivers text: conform it to the declared types.
    raw = _raw(spark, sf_dir)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    target = schemas.CURATED_TRANSACTIONS
    return _wall_clock(conform(text, T.StructType([target[c] for c in
                                                   ("transaction_id", "quantity", "ingestion_timestamp")])))


def q_flag_missing_required(spark, sf_dir):
    return _typed(spark, sf_dir).select("transaction_id", "customer_id", "product_id", "missing_required")


def q_flag_amount(spark, sf_dir):
    r = _run(spark, sf_dir)
    return _money_out(r.tagged.select("transaction_id", "amount", "valid_amount"))


def q_flag_date(spark, sf_dir):
    valid = date_in_range("transaction_date", FIXTURE_CONFIG.min_date, FIXTURE_CONFIG.max_date)
    return _typed(spark, sf_dir).select("transaction_id", "transaction_date", valid.alias("valid_date"))


def _typed(spark, sf_dir):
    """The typed rows alone: no reference check and no ceiling, so building
    the frame runs no job."""
    return standardize(_raw(spark, sf_dir), FIXTURE_CONFIG)


def _checked(spark, sf_dir):
    _prepare(spark)
    t, c, p = fixture_tables(spark, sf_dir)
    return check_references(standardize(t, FIXTURE_CONFIG), c, p, FIXTURE_CONFIG)


def q_check_customer_ref(spark, sf_dir):
    return _checked(spark, sf_dir).select("transaction_id", "customer_id", "valid_customer_ref")


def q_check_product_ref(spark, sf_dir):
    return _checked(spark, sf_dir).select("transaction_id", "product_id", "valid_product_ref")


def q_reject_reason(spark, sf_dir):
    return _run(spark, sf_dir).tagged.select("transaction_id", "source_file", "reject_reason")


def q_rejected(spark, sf_dir):
    return _money_out(_run(spark, sf_dir).rejected)


def q_orphans(spark, sf_dir):
    _prepare(spark)
    t, c, p = fixture_tables(spark, sf_dir)
    return orphans(t, {"customer": ("customer_id", c, "customer_id"),
                       "product": ("product_id", p, "product_id")})


def q_funnel(spark, sf_dir):
    return _run(spark, sf_dir).funnel()


def q_amount_ceiling(spark, sf_dir):
    """One lazy plan over the shared checked rows."""
    _prepare(spark)
    counts = value_counts(_shared(spark, sf_dir), "amount")
    found = ceiling_of(counts, FIXTURE_CONFIG.ceiling_percentile, FIXTURE_CONFIG.ceiling_factor,
                       FIXTURE_CONFIG.ceiling_fallback, schemas.MONEY.precision)
    return found.select(F.col("ceiling").cast("double").alias("amount_ceiling"))


def q_dedupe(spark, sf_dir):
    return _money_out(_run(spark, sf_dir).curated.select(
        "transaction_id", "customer_id", "product_id", "amount", "transaction_date", "source_file"))


def q_curated(spark, sf_dir):
    return _money_out(_run(spark, sf_dir).curated)


def q_monthly_revenue(spark, sf_dir):
    return A.monthly_revenue(_run(spark, sf_dir).curated)


def q_mom_growth(spark, sf_dir):
    return A.mom_growth(_run(spark, sf_dir).curated)


def q_top_products(spark, sf_dir):
    return A.top_products(_run(spark, sf_dir).curated, _published_products(spark, sf_dir), 10, "revenue")


def q_top_products_by_volume(spark, sf_dir):
    return A.top_products(_run(spark, sf_dir).curated, _published_products(spark, sf_dir), 10, "orders")


def q_top_products_by_units(spark, sf_dir):
    return A.top_products(_run(spark, sf_dir).curated, _published_products(spark, sf_dir), 10, "units")


def q_top_products_by_id(spark, sf_dir):
    # Volume grouped by product id and name: products sharing a name stay apart.
    return A.top_products(_run(spark, sf_dir).curated, _published_products(spark, sf_dir), 10,
                          "orders", by="id")


def q_top_customers(spark, sf_dir):
    return A.top_customers(_run(spark, sf_dir).curated, _published_customers(spark, sf_dir), 20)


def q_top_10_customers(spark, sf_dir):
    return A.top_customers(_run(spark, sf_dir).curated, _published_customers(spark, sf_dir), 10)


def q_avg_order_value(spark, sf_dir):
    return A.avg_order_value(_run(spark, sf_dir).curated, _published_products(spark, sf_dir))


def q_reject_rate(spark, sf_dir):
    return A.reject_rate(_run(spark, sf_dir).rejected)


def q_curated_count(spark, sf_dir):
    return A.curated_count(_run(spark, sf_dir).curated)


def q_run_health(spark, sf_dir):
    r = _run(spark, sf_dir)
    return A.run_health(A.metrics_by_source(r.tagged, r.curated, K.STAGE_CLEAN_AND_CURATE))


FINGERPRINT_COLUMNS = ["transaction_id", "customer_id", "product_id", "amount", "transaction_date"]


def q_fingerprint(spark, sf_dir):
    return fingerprint(_run(spark, sf_dir).curated, FINGERPRINT_COLUMNS)


def q_rerun_compare(spark, sf_dir):
    a = _run(spark, sf_dir)
    # Second run over the same rows, differently partitioned.
    raw_b = _raw(spark, sf_dir).repartition("source_file", "amount")
    b = _run(spark, sf_dir, raw=raw_b)
    return compare_outputs(a.curated, b.curated)


# --- what the writers wrote, read back -------------------------------------

_WRITTEN: dict = {}


def _written(spark, sf_dir) -> BatchPaths:
    """Run the batch job over a CSV landing of the fixture into a fresh folder
    under the checkpoint folder, once per session and folder."""
    _prepare(spark)
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _WRITTEN:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/verity-readback/{uuid.uuid4().hex}"
        paths = BatchPaths.under(f"{root}/raw", f"{root}/out")
        for df, path in zip(fixture_tables(spark, sf_dir),
                            (paths.raw_transactions, paths.raw_customers, paths.raw_products)):
            _land(df, path)
        run_batch(spark, paths, RUN_ID, FIXTURE_CONFIG, register=False)
        _WRITTEN[key] = paths
    return _WRITTEN[key]


def q_curated_readback(spark, sf_dir):
    return _money_out(read_curated(spark, _written(spark, sf_dir).curated))


def q_rejected_readback(spark, sf_dir):
    """A CSV landing has no empty text: an empty id comes back as NULL, so both
    sides show it as NULL."""
    out = _money_out(read_rejected(spark, _written(spark, sf_dir).rejected))
    return out.withColumn("customer_id", F.nullif("customer_id", F.lit("")))


def q_merged_readback(spark, sf_dir):
    """The same batch once more in merge mode, over what is stored."""
    paths = _written(spark, sf_dir)
    run_batch(spark, paths, RUN_ID, FIXTURE_CONFIG, register=False, merge=True, publish=False)
    return _money_out(read_curated(spark, paths.curated))


def q_metrics_readback(spark, sf_dir):
    return read_run_metrics(spark, _written(spark, sf_dir).metrics).select(
        "run_id", "stage", "raw_count", "rejected_count", "curated_count")


def q_catalog_counts(spark, sf_dir):
    """Rows of every table the catalog answers for after stage 2."""
    publish_catalog(spark, _written(spark, sf_dir), "readback_curated", "readback_rejected")
    out = None
    for name in ("curated.transactions", "curated.customers", "curated.products", "curated.run_metrics",
                 "rejected.transactions"):
        part = spark.table(f"readback_{name}").agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionAll(part)
    return out


def q_run_difference(spark, sf_dir):
    """Two runs that differ: the second accepts dates of the first half only."""
    _prepare(spark)
    t, c, p = fixture_tables(spark, sf_dir)
    a = _run(spark, sf_dir)
    half = clean_and_curate(t, c, p, RUN_ID, config=replace(FIXTURE_CONFIG, max_date=HALF_DATE),
                            checked=_shared(spark, sf_dir))  # which dates are valid is decided later
    return compare_outputs(a.curated, half.curated)


# --- kept up to date over several runs ---------------------------------------

def _once(spark, sf_dir, name: str, make):
    """What ``make`` returns, built once per session and folder."""
    _prepare(spark)
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = make()
    return _WRITTEN[key]


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/verity-{name}/{uuid.uuid4().hex}"


def _land(df: DataFrame, path: str) -> None:
    """A landing of gzipped CSV, quickly compressed, in files small enough for
    a task each, as no reader can split them. The writer would trim values by
    default; blanks are part of the fixture."""
    with session_settings(df.sparkSession, spark__sql__files__maxPartitionBytes="64m"):
        (df.select(*[df[c].cast("string") for c in df.columns]).write.option("header", True)
         .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


LATE_RUN = "fixture-late"


def by_month(raw: DataFrame) -> DataFrame:
    """Every row with its date moved to the first of the month: 84 days to
    write instead of 2,500, for the queries that store several runs."""
    date = F.regexp_replace("transaction_date", r"^([0-9]{4}-[0-9]{2})-[0-9]{2}$", "$1-01")
    return raw.withColumn("transaction_date", F.regexp_replace(date, r"^([0-9]{2})/[0-9]{2}/([0-9]{4})$", "$1/01/$2"))


def _months(spark, sf_dir) -> DataFrame:
    """The fixture's rows by month, written once: the queries that store
    several runs read them for each."""
    return _once(spark, sf_dir, "months", lambda: _staged(by_month(fixture_tables(spark, sf_dir)[0])))


def late_rows(raw: DataFrame) -> DataFrame:
    """A later batch over the same ids: a seventh of the transactions come
    again, half of these under another date."""
    return raw.where("quantity % 7 = 3").withColumns({
        "transaction_date": F.when(F.expr("quantity % 2 = 0"), F.lit("1996-03-05")).otherwise(F.col("transaction_date")),
        "ingestion_timestamp": F.lit("2002-02-02 00:00:00"), "source_file": F.lit("late.csv")})


def _moved(spark, sf_dir) -> str:
    """Two runs, published as a whole through the catalog; the second merges
    by id, so rows leave days it does not carry. Returns the database."""
    def make():
        _, c, p = fixture_tables(spark, sf_dir)
        t = _months(spark, sf_dir)
        db = f"moved_{zlib.crc32(sf_dir.encode()):08x}"
        root = _folder(spark, "moved")
        for run, rows, how in ((RUN_ID, t, {}),
                               (LATE_RUN, late_rows(t), {"merge": True, "merge_scope": "table", "rollups": True})):
            paths = BatchPaths.under(f"{root}/{run}", f"{root}/out")
            for df, path in zip((rows, c, p), (paths.raw_transactions, paths.raw_customers, paths.raw_products)):
                _land(df, path)
            run_batch(spark, paths, run, FIXTURE_CONFIG, release=True, curated_db=db, rejected_db=f"{db}_rejected", **how)
        return db
    return _once(spark, sf_dir, "moved", make)


def q_merge_moves(spark, sf_dir):
    return _money_out(spark.table(f"{_moved(spark, sf_dir)}.transactions"))


def q_released_rejects(spark, sf_dir):
    """Rejects per run, by the partitions the catalog points to."""
    out = spark.table(f"{_moved(spark, sf_dir)}_rejected.transactions")
    return out.groupBy("run_id", "reject_reason").agg(F.count(F.lit(1)).alias("rows_rejected"))


def q_released_metrics(spark, sf_dir):
    return spark.table(f"{_moved(spark, sf_dir)}.run_metrics").select(
        "run_id", "stage", "raw_count", "rejected_count", "curated_count")


def _daily(spark, sf_dir, name):
    return spark.table(f"{_moved(spark, sf_dir)}.{name}")


def q_rollup_monthly_revenue(spark, sf_dir):
    return R.monthly_revenue(_daily(spark, sf_dir, "daily_products"))


def q_rollup_mom_growth(spark, sf_dir):
    return R.mom_growth(_daily(spark, sf_dir, "daily_products"))


def q_rollup_top_products(spark, sf_dir):
    return R.top_products(_daily(spark, sf_dir, "daily_products"), _published_products(spark, sf_dir))


def q_rollup_top_customers(spark, sf_dir):
    return R.top_customers(_daily(spark, sf_dir, "daily_customers"), _published_customers(spark, sf_dir))


def q_rollup_avg_order_value(spark, sf_dir):
    return R.avg_order_value(_daily(spark, sf_dir, "daily_products"), _published_products(spark, sf_dir))


def q_run_difference_by_day(spark, sf_dir):
    """The first batch's rows against the table after the late run, by kept
    digests: per day that differs, the rows that only one of them has. The
    first batch and the stored runs only share the raw rows, and are made
    together."""
    by = list(K.PARTITION_COLUMNS)
    _, c, p = fixture_tables(spark, sf_dir)

    def first_batch(root, t):
        checked = _staged(check_references(standardize(t, FIXTURE_CONFIG), c, p, FIXTURE_CONFIG, stage_rows=False))
        write_curated(clean_and_curate(t, c, p, RUN_ID, config=FIXTURE_CONFIG, checked=checked).curated, f"{root}/rows")
        write_digests(read_curated(spark, f"{root}/rows"), f"{root}/a", by)

    def stored(root):
        write_digests(spark.table(f"{_moved(spark, sf_dir)}.transactions"), f"{root}/b", by)

    def make():
        root, t = _folder(spark, "digests"), _months(spark, sf_dir)
        concurrently(lambda: stored(root), lambda: first_batch(root, t))
        return root
    root = _once(spark, sf_dir, "digests", make)
    a, b = read_curated(spark, f"{root}/rows"), spark.table(f"{_moved(spark, sf_dir)}.transactions")
    return compare_by_digest(a, b, read_digests(spark, f"{root}/a", by), read_digests(spark, f"{root}/b", by),
                             by, each=True)


def q_ceiling_by_day(spark, sf_dir):
    """The ceiling from stored counts by month, after the counts of one year
    were replaced: doubled amounts, but for 1996."""
    by = ["year", "month"]

    def make():
        path = f"{_folder(spark, 'counts')}/amounts"
        typed = _typed(spark, sf_dir)
        dated = _staged(typed.select("amount", *partition_columns("transaction_date")[:2]))
        doubled = dated.withColumn("amount", F.col("amount").cast("decimal(18,2)") * 2)
        write_value_counts(doubled.withColumn("amount", F.col("amount").cast("decimal(18,2)")), path, "amount", by)
        write_value_counts(dated.where("year = '1996'"), path, "amount", by)
        return path
    counts = read_value_counts(spark, _once(spark, sf_dir, "counts", make), by)
    return ceiling_of(counts, FIXTURE_CONFIG.ceiling_percentile, FIXTURE_CONFIG.ceiling_factor,
                      FIXTURE_CONFIG.ceiling_fallback, 11).select(F.col("ceiling").cast("double").alias("amount_ceiling"))


def q_rerun_proof(spark, sf_dir):
    """The fixture's batch through the writers twice; raises on a difference."""
    def make():
        paths = BatchPaths.under(*(f"{_folder(spark, 'proof')}/{part}" for part in ("raw", "out")))
        t, c, p = fixture_tables(spark, sf_dir)
        for df, path in ((by_month(t), paths.raw_transactions), (c, paths.raw_customers), (p, paths.raw_products)):
            _land(df, path)
        return rerun_proof(spark, paths, RUN_ID, FIXTURE_CONFIG, register=False, publish=False)
    return _once(spark, sf_dir, "proof", make)


TYPED_RAW = T.StructType([T.StructField("transaction_date", T.DateType()), T.StructField("amount", schemas.MONEY),
                          T.StructField("quantity", T.IntegerType()),
                          T.StructField("ingestion_timestamp", T.TimestampType())])


def q_file_drift(spark, sf_dir):
    """Three landings of a third of the fixture each: as declared; amount and
    quantity swapped; without promo_code and with a channel. Files of a
    landing are added up."""
    def make():
        root = _folder(spark, "drift")
        raw = _raw(spark, sf_dir)
        cols = raw.columns
        swapped = [{"amount": "quantity", "quantity": "amount"}.get(c, c) for c in cols]
        _land(raw.where("quantity % 3 = 0"), f"{root}/a")
        _land(raw.where("quantity % 3 = 1").select(*swapped), f"{root}/b")
        _land(raw.where("quantity % 3 = 2").drop("promo_code").withColumn("Channel-Name", F.lit("web")), f"{root}/c")
        return root
    found = file_profile(spark, _once(spark, sf_dir, "drift", make), schemas.RAW_TRANSACTIONS, TYPED_RAW)
    counts = ["n_rows", "n_null", "n_bigint", "n_double", "n_date", "n_timestamp", "n_uncastable"]
    return (found.withColumn("landing", F.element_at(F.split("file", "/"), -2))
            .groupBy("landing", "column_name", "position", "declared")
            .agg(*[F.sum(c).alias(c) for c in counts], F.bool_or("departs").alias("departs")))


def _hard(spark, sf_dir):
    """The fixture with the rarer defects: malformed and missing timestamps,
    one-digit dates, the literal default promo code and blank ones, null
    transaction ids, padded dimension keys."""
    _prepare(spark)
    t, c, p = fixture_tables(spark, sf_dir)
    q = F.col("quantity") % 10
    ts, date = F.col("ingestion_timestamp"), F.col("transaction_date")
    hard = t.withColumns({
        "ingestion_timestamp": F.when(q == 1, F.lit("not-a-time")).when(q == 2, F.lit(""))
        .when(q == 3, F.lit("2025-02-30 10:00:00")).otherwise(ts),
        "transaction_date": F.when(q == 4, F.lit("1/5/1997")).otherwise(date),
        "promo_code": F.when(q == 5, F.lit("NONE")).when(q == 6, F.lit("  ")).otherwise(F.col("promo_code")),
        "transaction_id": F.when(F.col("quantity") % 20 == 7, F.lit(None).cast("string")).otherwise(F.col("transaction_id"))})
    padded = c.withColumn("customer_id", F.concat(F.lit(" "), F.col("customer_id"), F.lit("  ")))
    return hard, padded, p


def _hard_run(spark, sf_dir):
    t, c, p = _hard(spark, sf_dir)
    checked = _once(spark, sf_dir, "hard", lambda: _staged(
        check_references(standardize(t, FIXTURE_CONFIG), c, p, FIXTURE_CONFIG)))
    return clean_and_curate(t, c, p, RUN_ID, config=FIXTURE_CONFIG, checked=checked)


def q_curated_hard(spark, sf_dir):
    return _money_out(_hard_run(spark, sf_dir).curated)


def q_rejected_hard(spark, sf_dir):
    return _money_out(_hard_run(spark, sf_dir).rejected)


def q_conform_raw(spark, sf_dir):
    """Every raw column to its curated type, casts that fail included."""
    raw = _hard(spark, sf_dir)[0]
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return _money_out(conform(text, T.StructType([schemas.CURATED_TRANSACTIONS[c] for c in raw.columns])))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "schema_profile": q_schema_profile,
    "publish_customers": q_publish_customers,
    "publish_products": q_publish_products,
    "standardize_names": q_standardize_names,
    "parse_amount": q_parse_amount,
    "parse_date": q_parse_date,
    "parse_timestamp": q_parse_timestamp,
    "trim_ids": q_trim_ids,
    "impute_promo": q_impute_promo,
    "partition_columns": q_partition_columns,
    "conform_types": q_conform_types,
    "flag_missing_required": q_flag_missing_required,
    "flag_amount": q_flag_amount,
    "flag_date": q_flag_date,
    "reject_reason": q_reject_reason,
    "rejected": q_rejected,
    "check_customer_ref": q_check_customer_ref,
    "check_product_ref": q_check_product_ref,
    "orphans": q_orphans,
    "funnel": q_funnel,
    "amount_ceiling": q_amount_ceiling,
    "monthly_revenue": q_monthly_revenue,
    "top_products": q_top_products,
    "top_customers": q_top_customers,
    "avg_order_value": q_avg_order_value,
    "reject_rate": q_reject_rate,
    "top_products_by_volume": q_top_products_by_volume,
    "top_products_by_units": q_top_products_by_units,
    "top_products_by_id": q_top_products_by_id,
    "curated_count": q_curated_count,
    "fingerprint": q_fingerprint,
    "dedupe": q_dedupe,
    "mom_growth": q_mom_growth,
    "top_10_customers": q_top_10_customers,
    "rerun_compare": q_rerun_compare,
    "curated": q_curated,
    "run_health": q_run_health,
    "curated_readback": q_curated_readback,
    "rejected_readback": q_rejected_readback,
    "merged_readback": q_merged_readback,
    "metrics_readback": q_metrics_readback,
    "catalog_counts": q_catalog_counts,
    "run_difference": q_run_difference,
    "merge_moves": q_merge_moves,
    "released_rejects": q_released_rejects,
    "released_metrics": q_released_metrics,
    "rollup_monthly_revenue": q_rollup_monthly_revenue,
    "rollup_mom_growth": q_rollup_mom_growth,
    "rollup_top_products": q_rollup_top_products,
    "rollup_top_customers": q_rollup_top_customers,
    "rollup_avg_order_value": q_rollup_avg_order_value,
    "run_difference_by_day": q_run_difference_by_day,
    "ceiling_by_day": q_ceiling_by_day,
    "rerun_proof": q_rerun_proof,
    "file_drift": q_file_drift,
    "curated_hard": q_curated_hard,
    "rejected_hard": q_rejected_hard,
    "conform_raw": q_conform_raw,
}
