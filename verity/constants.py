"""Values that must equal the reference pipeline's for identical results.

Everything else in the package is parametrised; these are the defaults the
retail pipeline is configured with.
"""
from decimal import Decimal

# --- fixed values (must match the reference exactly) ---------------------
# Reject reasons, in priority order: the first failing rule names the row.
REASON_MISSING_REQUIRED = "missing_required_field"
REASON_INVALID_AMOUNT = "invalid_amount"
REASON_INVALID_DATE = "invalid_date"
REASON_ORPHAN_REFERENCE = "orphan_reference"
# Identifier columns that must be present and non-blank.
REQUIRED_TXN_COLUMNS = ("transaction_id", "customer_id", "product_id")
# Characters stripped from amount text before the numeric check.
AMOUNT_STRIP_PATTERN = r"[$,\s]"
# Shape an amount must have after stripping.
AMOUNT_PATTERN = r"^-?\d+(\.\d+)?$"
# Accepted date layouts: shape guard and parse format, tried in this order.
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
ISO_DATE_FORMAT = "yyyy-MM-dd"
US_DATE_PATTERN = r"^\d{1,2}/\d{1,2}/\d{4}$"
US_DATE_FORMAT = "MM/dd/yyyy"
# Outlier ceiling: factor x the percentile of amount; fallback when it is NULL or 0.
CEILING_PERCENTILE = 0.99
CEILING_FACTOR = Decimal("3.0")
CEILING_FALLBACK = Decimal("1000000")
# Default accepted transaction date range (inclusive).
DEFAULT_MIN_DATE = "2024-01-01"
DEFAULT_MAX_DATE = "2026-12-31"
# Value written for a missing promo code.
PROMO_DEFAULT = "NONE"
# Stage name written to run metrics by the clean-and-curate job.
STAGE_CLEAN_AND_CURATE = "clean_and_curate"
# Partition column names of the curated table.
PARTITION_COLUMNS = ("year", "month", "day")
# --- end of fixed values --------------------------------------------------
