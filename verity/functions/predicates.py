"""Boolean checks. They never return NULL, so a rule built on them
always decides."""
from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column) -> Column:
    """NULL, empty, or only spaces."""
    col = _col(c)
    return col.isNull() | (F.trim(col.cast("string")) == F.lit(""))


def any_missing(cols: Iterable[str | Column]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | is_missing(c)
    return out


def amount_in_range(c: str | Column, ceiling) -> Column:
    """Present, strictly positive and at most ``ceiling`` (literal or Column)."""
    col = _col(c)
    ceil = ceiling if isinstance(ceiling, Column) else F.lit(ceiling)
    return F.coalesce(col.isNotNull() & (col > 0) & (col <= ceil), F.lit(False))


def _date_lit(d) -> Column:
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def date_in_range(c: str | Column, min_date, max_date) -> Column:
    """Present and inside ``[min_date, max_date]``."""
    col = _col(c)
    return F.coalesce(col.isNotNull() & col.between(_date_lit(min_date), _date_lit(max_date)),
                      F.lit(False))
