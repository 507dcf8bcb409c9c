"""Clean and curate one batch of raw transactions.

Order of work (every step a Column builder or table operator):
names -> types -> missing/imputed -> ceiling -> amount, date and reference
checks -> reject reason -> split -> dedupe -> partition columns -> run id.
All of it is lazy except the ceiling, a scalar computed by distributed
aggregates (see ``verity.operators.quantile``).
"""
from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity import constants as K
from verity import schemas
from verity.functions.names import standardize_column_names
from verity.functions.parsing import (
    DEFAULT_DATE_LAYOUTS, parse_amount, parse_date, parse_timestamp, partition_columns, trim_text,
)
from verity.functions.predicates import amount_in_range, any_missing, date_in_range
from verity.functions.imputation import impute
from verity.operators.dedupe import dedupe
from verity.operators.quantile import ceiling as compute_ceiling
from verity.operators.references import DEFAULT_BROADCAST_MAX_ROWS, check_reference, fits_broadcast, stage_keys
from verity.operators.rules import Rule, split, tag


@dataclass(frozen=True)
class CurationConfig:
    min_date: str = K.DEFAULT_MIN_DATE
    max_date: str = K.DEFAULT_MAX_DATE
    required: tuple[str, ...] = K.REQUIRED_TXN_COLUMNS
    date_layouts: tuple[tuple[str, str], ...] = DEFAULT_DATE_LAYOUTS
    ceiling_percentile: float = K.CEILING_PERCENTILE
    ceiling_factor: Decimal = K.CEILING_FACTOR
    ceiling_fallback: Decimal = K.CEILING_FALLBACK
    ceiling_mode: str = "exact"          # "approx" (one sketch pass) or "stat" (original call)
    ceiling_accuracy: int = 10_000
    ceiling_scope: str = "batch"         # "history": over the stored counts of every run (run_batch)
    promo_default: str = K.PROMO_DEFAULT
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS
    dedupe_keys: tuple[str, ...] = ("transaction_id",)


ID_COLUMNS = ("transaction_id", "customer_id", "product_id")
CURATED_COLUMNS = schemas.names(schemas.CURATED_TRANSACTIONS)
REJECTED_COLUMNS = schemas.names(schemas.REJECTED_TRANSACTIONS)
# Columns after transaction_id that make the dedupe order total.
DEDUPE_TIE_BREAK = ("customer_id", "product_id", "amount", "transaction_date", "quantity",
                    "promo_code", "is_imputed")


def standardize(raw: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Names, types, trimmed ids, imputed promo code, missing-field flag."""
    df = standardize_column_names(raw)
    promo, imputed = impute(F.col("promo_code"), config.promo_default)
    typed = df.select(
        *[trim_text(c).alias(c) for c in ID_COLUMNS],
        parse_amount("amount").alias("amount"),
        parse_date("transaction_date", config.date_layouts).alias("transaction_date"),
        F.col("quantity").try_cast("int").alias("quantity"),
        promo.alias("promo_code"),
        imputed.alias("is_imputed"),
        parse_timestamp("ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("source_file").cast("string").alias("source_file"),
    )
    return typed.withColumn("missing_required", any_missing(config.required))


def check_references(typed: DataFrame, customers: DataFrame, products: DataFrame,
                     config: CurationConfig = CurationConfig(),
                     stage_dir: str | None = None, stage_rows: bool = True) -> DataFrame:
    """Both reference flags. ``stage_dir`` receives key sets too large to
    broadcast (see ``check_reference``), and the typed rows when there is such
    a set: the check then reads their key columns apart from the rows.
    ``stage_rows=False`` leaves the rows where they are, for those that come
    straight from columnar files, whose key columns can be read apart as well."""
    customers, products = standardize_column_names(customers), standardize_column_names(products)
    if stage_rows and 0 < config.broadcast_max_rows and not (
            fits_broadcast(customers, config.broadcast_max_rows, columns=("customer_id",))
            and fits_broadcast(products, config.broadcast_max_rows, columns=("product_id",))):
        typed = stage_keys(typed, stage_dir)
    df = check_reference(typed, "customer_id", customers,
                         flag="valid_customer_ref", broadcast_max_rows=config.broadcast_max_rows,
                         stage_dir=stage_dir)
    return check_reference(df, "product_id", products,
                           flag="valid_product_ref", broadcast_max_rows=config.broadcast_max_rows,
                           stage_dir=stage_dir)


def amount_ceiling(typed: DataFrame, config: CurationConfig = CurationConfig()) -> Decimal:
    """Over every row with an amount: duplicates, invalid and negative ones too."""
    return compute_ceiling(typed, "amount", config.ceiling_percentile, config.ceiling_factor,
                           config.ceiling_fallback, config.ceiling_mode, config.ceiling_accuracy)


# Priority order: the first failing rule names the row. Each rule reads a
# flag column computed before (see ``validate`` and ``check_references``).
RULES = (
    (K.REASON_MISSING_REQUIRED, lambda: ~F.col("missing_required")),
    (K.REASON_INVALID_AMOUNT, lambda: F.col("valid_amount")),
    (K.REASON_INVALID_DATE, lambda: F.col("valid_date")),
    (K.REASON_ORPHAN_REFERENCE, lambda: F.col("valid_customer_ref") & F.col("valid_product_ref")),
)


def rules() -> list[Rule]:
    return [Rule(reason, passes()) for reason, passes in RULES]


def validate(checked: DataFrame, ceiling, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Add the amount and date checks, then ``reject_reason``."""
    df = checked.withColumns({
        "valid_amount": amount_in_range("amount", ceiling),
        "valid_date": date_in_range("transaction_date", config.min_date, config.max_date),
    })
    return tag(df, rules())


def dedupe_valid(valid: DataFrame, config: CurationConfig = CurationConfig()) -> DataFrame:
    """Latest ingestion wins, then the smallest source file, then the other
    columns; only rows that passed every check compete."""
    return dedupe(valid.select(*[c for c in schemas.names(schemas.CURATED_TRANSACTIONS)
                                 if c in valid.columns]),
                  list(config.dedupe_keys),
                  [F.col("ingestion_timestamp").desc_nulls_last(), F.col("source_file").asc_nulls_first()],
                  tie_break=DEDUPE_TIE_BREAK)


def to_curated(deduped: DataFrame, run_id: str) -> DataFrame:
    df = deduped.withColumn("run_id", F.lit(run_id))
    return df.select(*[c for c in CURATED_COLUMNS if c not in K.PARTITION_COLUMNS],
                     *partition_columns("transaction_date"))


def to_rejected(invalid: DataFrame, run_id: str) -> DataFrame:
    return invalid.withColumn("run_id", F.lit(run_id)).select(*REJECTED_COLUMNS)


@dataclass
class CurationResult:
    typed: DataFrame
    tagged: DataFrame
    curated: DataFrame
    rejected: DataFrame
    ceiling: Decimal

    def funnel(self) -> DataFrame:
        """One row: raw_count, rejected_count, curated_count,
        duplicates_dropped. One pass over the tagged rows: the curated count
        is the number of distinct ids among valid rows, which is what the
        dedupe keeps."""
        valid = F.col("reject_reason").isNull()
        return self.tagged.agg(
            F.count(F.lit(1)).alias("raw_count"),
            F.count_if(~valid).alias("rejected_count"),
            F.count_distinct(F.when(valid, F.col("transaction_id"))).alias("curated_count"),
        ).withColumn("duplicates_dropped",
                     F.col("raw_count") - F.col("rejected_count") - F.col("curated_count"))

    def counts(self, run_id: str | None = None) -> dict:
        """The funnel as a dict (one job): raw_count, rejected_count,
        curated_count, duplicates_dropped, and run_id when given."""
        out = self.funnel().first().asDict()
        return {"run_id": run_id, **out} if run_id is not None else out


def clean_and_curate(transactions: DataFrame, customers: DataFrame, products: DataFrame,
                     run_id: str, min_date: str | None = None, max_date: str | None = None,
                     config: CurationConfig | None = None, ceiling=None,
                     checked: DataFrame | None = None) -> CurationResult:
    """The whole stage-1 transform. ``ceiling`` may be given to skip its
    computation; ``checked`` lets a caller pass a persisted frame of
    ``check_references(standardize(...))``."""
    config = config or CurationConfig()
    if min_date or max_date:
        from dataclasses import replace
        config = replace(config, min_date=min_date or config.min_date,
                         max_date=max_date or config.max_date)
    typed = standardize(transactions, config)
    if ceiling is None:
        # From the persisted frame when there is one, else from the typed
        # rows (the reference joins do not change the amounts).
        ceiling = amount_ceiling(checked if checked is not None else typed, config)
    if checked is None:
        checked = check_references(typed, customers, products, config)
    tagged = validate(checked, ceiling, config)
    valid, invalid = split(tagged)
    curated = to_curated(dedupe_valid(valid, config), run_id)
    rejected = to_rejected(invalid, run_id)
    return CurationResult(typed, tagged, curated, rejected, ceiling)
