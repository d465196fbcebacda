"""Weather-derived features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _vapour_pressure(t: Column) -> Column:
    # e = 6.11 * 10^(7.5 T / (237.3 + T))
    return F.lit(6.11) * F.pow(F.lit(10.0), F.lit(7.5) * t / (F.lit(237.3) + t))


def relative_humidity(air: Column, dew: Column) -> Column:
    """Relative humidity in percent from air and dew temperature (deg C)."""
    return F.try_divide(_vapour_pressure(dew) * 100, _vapour_pressure(air))


def wind_components(df: DataFrame, col: str = "wind_direction", drop: bool = False) -> DataFrame:
    """``{col}_x`` = cos, ``{col}_y`` = sin of the compass degrees; x is 0 when
    the direction is 0 (calm)."""
    rad = F.radians(F.col(col))
    out = df.withColumns({
        f"{col}_x": F.when(F.col(col) == 0, F.lit(0.0)).otherwise(F.cos(rad)),
        f"{col}_y": F.sin(rad),
    })
    return out.drop(col) if drop else out
