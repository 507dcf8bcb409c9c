"""Default a missing optional value and flag that it was imputed."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verity.functions.predicates import is_missing


def impute(c: str | Column, default) -> tuple[Column, Column]:
    """``(value, was_imputed)``: NULL or blank becomes ``default``; other
    values are kept untouched. The flag comes from the missing test, so a real
    value that happens to equal the default is not marked imputed."""
    col = F.col(c) if isinstance(c, str) else c
    missing = is_missing(col)
    return F.when(missing, F.lit(default)).otherwise(col), missing
