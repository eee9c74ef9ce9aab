"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (and floating arrays) to ``digits`` places
    so results compare by value hash across engines."""
    exprs = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs[f.name] = F.round(F.col(f.name).cast("double"), digits)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType,
                                                                (T.DoubleType, T.FloatType)):
            exprs[f.name] = F.transform(F.col(f.name), lambda x: F.round(x.cast("double"), digits))
    return df.withColumns(exprs) if exprs else df
