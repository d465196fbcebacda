"""Helpers shared by registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, nd: int = 6) -> DataFrame:
    """Round every double/float column (engine-independent comparison)."""
    return df.select(*[F.round(F.col(f.name), nd).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])
