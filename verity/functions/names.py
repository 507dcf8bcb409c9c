"""lower_snake_case column names."""
from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Trim, lower-case, and turn spaces and hyphens into underscores.
    Other punctuation is kept as it is."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`clean_name` in one projection.

    Raises ``ValueError`` when two source names clean to the same name, which
    would otherwise leave ambiguous columns behind.
    """
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both standardise to {n!r}")
        seen[n] = old
    if new == df.columns:
        return df
    return df.toDF(*new)
