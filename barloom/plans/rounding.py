"""Rounding for comparison across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Means over 32 or 64 values often lie exactly between two roundings, where the last bit decides.
# Both engines therefore round x times this factor.
ROUNDING_NUDGE = 1 + 1e-13


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals."""
    return df.select(
        *(
            F.round(F.col(f.name) * ROUNDING_NUDGE, 6).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )
