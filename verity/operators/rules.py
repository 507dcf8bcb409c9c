"""ordered validation rules that give each bad row one reason."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``passes`` is True for a good row. A NULL result counts as a failure."""
    reason: str
    passes: Column


def reject_reason(rules: Sequence[Rule]) -> Column:
    """The reason of the first rule the row fails, else NULL."""
    if not rules:
        return F.lit(None).cast("string")
    expr = None
    for r in rules:
        failed = ~F.coalesce(r.passes, F.lit(False))
        expr = F.when(failed, F.lit(r.reason)) if expr is None else expr.when(failed, F.lit(r.reason))
    return expr.otherwise(F.lit(None).cast("string"))


def tag(df: DataFrame, rules: Sequence[Rule], name: str = "reject_reason") -> DataFrame:
    return df.withColumn(name, reject_reason(rules))


def split(df: DataFrame, name: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)`` halves of a tagged frame."""
    return df.where(F.col(name).isNull()), df.where(F.col(name).isNotNull())
