"""Target transforms, unit rules and blends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.constants import UNIT_FACTORS


def log_target(c: Column) -> Column:
    return F.log1p(c)


def exp_target(c: Column) -> Column:
    return F.expm1(c)


def clip_min(c: Column, lower: float = 0.0) -> Column:
    """Values below ``lower`` become ``lower``; NULL stays NULL."""
    return F.when(c < lower, F.lit(lower)).otherwise(c)


def convert_units(reading: Column, site: Column, meter: Column, site_num: int, meter_type: int,
                  conversion: str) -> Column:
    """Multiply one site+meter's readings by a named factor."""
    if conversion not in UNIT_FACTORS:
        raise ValueError(f"unknown conversion {conversion!r}; known: {sorted(UNIT_FACTORS)}")
    factor = F.lit(UNIT_FACTORS[conversion])
    return F.when((site == site_num) & (meter == meter_type), reading * factor).otherwise(reading)


def restore_site0_units(reading: Column, site: Column, meter: Column) -> Column:
    """Site 0: electricity back from kWh to kBTU, chilled water from tons to kBTU."""
    return (F.when((site == 0) & (meter == 0), reading * F.lit(UNIT_FACTORS["kwh_to_kbtu"]))
            .when((site == 0) & (meter == 1), reading * F.lit(UNIT_FACTORS["ton_to_kbtu"]))
            .otherwise(reading))


def blend(weights: dict[str, float]) -> Column:
    """Weighted mean of prediction columns.  Weights are normalised over the
    non-null inputs of each row, so an equal-weight blend is a row mean that
    skips nulls."""
    num = None
    den = None
    for col, w in weights.items():
        c = F.col(col)
        term = F.coalesce(c * F.lit(float(w)), F.lit(0.0))
        wt = F.when(c.isNull(), F.lit(0.0)).otherwise(F.lit(float(w)))
        num = term if num is None else num + term
        den = wt if den is None else den + wt
    return F.try_divide(num, F.when(den == 0, F.lit(None)).otherwise(den))
