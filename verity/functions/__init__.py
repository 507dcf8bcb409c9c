"""Column builders: each takes and returns a ``Column`` (or a name list)."""
from verity.functions.names import clean_name, standardize_column_names
from verity.functions.parsing import (
    clean_amount_text, parse_amount, parse_date, parse_timestamp, trim_text,
    partition_columns,
)
from verity.functions.predicates import (
    is_missing, any_missing, amount_in_range, date_in_range,
)
from verity.functions.imputation import impute
from verity.functions.hashing import null_safe_row_hash, portable_row_hash

__all__ = [
    "clean_name", "standardize_column_names", "clean_amount_text", "parse_amount",
    "parse_date", "parse_timestamp", "trim_text", "partition_columns", "is_missing",
    "any_missing", "amount_in_range", "date_in_range", "impute", "null_safe_row_hash",
    "portable_row_hash",
]
