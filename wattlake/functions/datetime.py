"""Calendar expressions on naive (timestamp_ntz) timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_PARTS = ("dayofyear", "month", "day", "dayofweek", "hour")


def weekday(ts: Column) -> Column:
    """Day of week with Monday = 0 (``F.weekday``, not ``F.dayofweek``)."""
    return F.weekday(ts)


def date_parts(df: DataFrame, parts=DATE_PARTS, time_col: str = "timestamp") -> DataFrame:
    """Add the requested calendar parts as int columns."""
    ts = F.col(time_col)
    exprs = {"dayofyear": F.dayofyear(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
             "dayofweek": weekday(ts), "hour": F.hour(ts)}
    unknown = set(parts) - set(exprs)
    if unknown:
        raise ValueError(f"unknown date parts: {sorted(unknown)}")
    return df.withColumns({p: exprs[p] for p in parts})


def is_weekend(ts: Column) -> Column:
    """1 for Saturday or Sunday, else 0."""
    return (weekday(ts) >= 5).cast("int")


def hour_offset_expr(offset_hours: Column) -> Column:
    return F.make_dt_interval(F.lit(0), offset_hours.cast("int"), F.lit(0), F.lit(0))


def shift_hours(ts: Column, offset_hours: Column) -> Column:
    """Add a whole number of hours to a naive timestamp (no zone rules)."""
    return ts + hour_offset_expr(offset_hours)
