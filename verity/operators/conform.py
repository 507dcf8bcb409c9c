"""P10: cast every column to a declared schema, NULL where the cast fails."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Columns of ``schema``, in its order, each ``try_cast`` to its type.

    A column named in ``schema`` but absent from ``df`` is an error; extra
    columns are dropped unless ``keep_extra``.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for conform: {missing}")
    cols = []
    for f in schema.fields:
        src = df.schema[f.name].dataType
        c = F.col(f.name)
        cols.append((c if src == f.dataType else c.try_cast(f.dataType)).alias(f.name))
    if keep_extra:
        names = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)
