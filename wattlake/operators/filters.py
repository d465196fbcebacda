"""Row filters.  All are plain predicates, so Catalyst pushes them into the
parquet scan where the column comes straight from the file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def get_site(df: DataFrame, site: int, site_col: str = "site_id") -> DataFrame:
    """Rows of one site, site column dropped."""
    return df.where(F.col(site_col) == site).drop(site_col)


def where_site_meter(df: DataFrame, site: int, meter: int, site_col: str = "site_id",
                     meter_col: str = "meter") -> DataFrame:
    return df.where((F.col(site_col) == site) & (F.col(meter_col) == meter))


def drop_nonpositive(df: DataFrame, col: str = "meter_reading") -> DataFrame:
    """Remove readings <= 0.  NULL readings are kept."""
    return df.where(~F.coalesce(F.col(col) <= 0, F.lit(False)))


def range_filter(df: DataFrame, col: str, lower=None, upper=None, lower_inclusive: bool = True,
                 upper_inclusive: bool = True) -> DataFrame:
    c = F.col(col)
    cond = F.lit(True)
    if lower is not None:
        cond = cond & ((c >= lower) if lower_inclusive else (c > lower))
    if upper is not None:
        cond = cond & ((c <= upper) if upper_inclusive else (c < upper))
    return df.where(cond)


def remove_outliers(df: DataFrame, col: str, upper: Column | float) -> DataFrame:
    """Keep rows with value <= upper (NULL values drop)."""
    return df.where(F.col(col) <= upper)


def membership(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def _midnight(d) -> dt.datetime:
    if isinstance(d, str):
        d = dt.datetime.fromisoformat(d)
    if isinstance(d, dt.datetime):
        return d
    return dt.datetime(d.year, d.month, d.day)


def time_slice(df: DataFrame, start, end, time_col: str = "timestamp") -> DataFrame:
    """Rows with start <= t <= end; date labels mean midnight."""
    s = F.lit(_midnight(start).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    e = F.lit(_midnight(end).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return df.where(F.col(time_col).between(s, e))


def nth_group(df: DataFrame, start: int, end: int, group_col: str = "meter",
              member_col: str = "building_id") -> DataFrame:
    """Rows of the members ranked [start, end) within each group (members
    ordered by id).  Ranking runs on the distinct (group, member) pairs, a
    table as small as the member dimension; the fact rows are then kept by
    a semi join, so no single task ever sees a whole group of fact rows."""
    pairs = df.select(group_col, member_col).distinct()
    ranked = (pairs.withColumn("__rank", F.row_number().over(
        Window.partitionBy(group_col).orderBy(member_col)))
        .where((F.col("__rank") > start) & (F.col("__rank") <= end))  # on the bare number: planned as a group limit
        .drop("__rank"))
    return df.join(ranked, [group_col, member_col], "left_semi")
