"""Typed values out of raw text. All are ANSI-safe: malformed
input becomes NULL, never an exception."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity import constants as K


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_amount_text(c: str | Column, strip_pattern: str = K.AMOUNT_STRIP_PATTERN) -> Column:
    """Remove currency symbols, thousands separators and whitespace."""
    return F.regexp_replace(_col(c), strip_pattern, "")


def parse_amount(c: str | Column, precision: int = 10, scale: int = 2,
                 pattern: str = K.AMOUNT_PATTERN,
                 strip_pattern: str = K.AMOUNT_STRIP_PATTERN) -> Column:
    """Money text such as ``$1,204.50`` to ``decimal(precision, scale)``.

    The cleaned text must match ``pattern``; values that do not fit the
    decimal become NULL (``try_cast``) rather than failing the job.
    """
    cleaned = clean_amount_text(c, strip_pattern)
    return F.when(cleaned.rlike(pattern), cleaned.try_cast(T.DecimalType(precision, scale)))


DEFAULT_DATE_LAYOUTS: tuple[tuple[str, str], ...] = (
    (K.ISO_DATE_PATTERN, K.ISO_DATE_FORMAT),
    (K.US_DATE_PATTERN, K.US_DATE_FORMAT),
)


def parse_date(c: str | Column,
               layouts: Sequence[tuple[str, str]] = DEFAULT_DATE_LAYOUTS) -> Column:
    """First layout whose shape matches and whose format parses wins.

    Shape-valid but calendar-invalid text (``2019-13-40``) and text the
    format rejects (``1/5/2025`` against ``MM/dd/yyyy``) become NULL.
    """
    col = _col(c)
    return F.coalesce(*[F.when(col.rlike(pat), F.try_to_date(col, fmt))
                        for pat, fmt in layouts])


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Text to timestamp in the session time zone; NULL when unparseable."""
    col = _col(c)
    return F.try_to_timestamp(col) if fmt is None else F.try_to_timestamp(col, F.lit(fmt))


def trim_text(c: str | Column) -> Column:
    """Strip leading and trailing spaces (tabs are kept, as in SQL ``trim``)."""
    return F.trim(_col(c))


def partition_columns(date_col: str | Column,
                      names: Sequence[str] = K.PARTITION_COLUMNS) -> list[Column]:
    """Zero-padded ``yyyy``, ``MM``, ``dd`` strings from a date column."""
    d = _col(date_col)
    return [F.date_format(d, fmt).alias(n) for fmt, n in zip(("yyyy", "MM", "dd"), names)]
