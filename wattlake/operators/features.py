"""Row features that need a group statistic (area normalisation) and the
feature-extraction steps of the scoring pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.datetime import is_weekend
from wattlake.functions.lookup import country_of_site
from wattlake.functions.target import exp_target
from wattlake.functions.weather import relative_humidity, wind_components


def _group_mean(df: DataFrame, col: str, per: str | None) -> DataFrame:
    """Mean of ``col`` per ``per`` (or overall) as a small table.  Its row
    count is the number of distinct ``per`` values (meter types: 4), so the
    join back is a broadcast; no window over an unbounded partition."""
    if per is None:
        return df.agg(F.avg(col).alias(f"__mean_{col}"))
    return df.groupBy(per).agg(F.avg(col).alias(f"__mean_{col}"))


def normalize_by_area(df: DataFrame, target: str = "meter_reading", area: str = "square_feet",
                      per: str | None = "meter") -> DataFrame:
    """target × mean(area) / area, the mean taken per meter type (or over
    all rows when ``per`` is None)."""
    means = _group_mean(df, area, per)
    joined = (df.join(F.broadcast(means), per, "left") if per
              else df.withColumn(f"__mean_{area}", means.select(f"__mean_{area}").scalar()))
    return (joined.withColumn(target, F.col(target) * F.col(f"__mean_{area}") / F.col(area))
            .drop(f"__mean_{area}").select(*df.columns))


def inverse_target(df: DataFrame, target: str = "meter_reading", area: str = "square_feet",
                   per: str | None = "meter", mean_area: DataFrame | None = None) -> DataFrame:
    """expm1(prediction) × area / mean(area).  By default the mean is over
    the scored rows (per meter type); pass ``mean_area`` (columns ``per``,
    ``__mean_{area}``) to use a stored training mean instead."""
    means = mean_area if mean_area is not None else _group_mean(df, area, per)
    joined = (df.join(F.broadcast(means), per, "left") if per
              else df.withColumn(f"__mean_{area}", means.select(f"__mean_{area}").scalar()))
    return (joined.withColumn(target, exp_target(F.col(target)) * F.col(area) / F.col(f"__mean_{area}"))
            .drop(f"__mean_{area}").select(*df.columns))


def weather_features(df: DataFrame, dir_col: str = "wind_direction", air_col: str = "air_temperature",
                     dew_col: str = "dew_temperature") -> DataFrame:
    """rel_humidity, wind x/y components; the direction column is dropped."""
    out = df.withColumn("rel_humidity", relative_humidity(F.col(air_col), F.col(dew_col)))
    return wind_components(out, dir_col, drop=True)


def time_features(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    ts = F.col(time_col)
    return df.withColumns({"dayofyear": F.dayofyear(ts), "dayofweek": F.weekday(ts), "hour": F.hour(ts),
                           "is_weekend": is_weekend(ts)})


def holiday_features(df: DataFrame, calendar: DataFrame, site_col: str = "site_id",
                     time_col: str = "timestamp", countries: dict | None = None) -> DataFrame:
    """country of the site, and is_holiday = 1 when the row's date is a
    holiday of that country.  The calendar is a small generated dimension
    (countries × years × ~12 rules), broadcast."""
    from wattlake.operators.holidays import flag_holidays
    out = df.withColumn("country", country_of_site(F.col(site_col), countries))
    return flag_holidays(out, calendar, time_col=time_col)


def feature_frame(df: DataFrame, calendar: DataFrame, feats: Sequence[str] | None) -> DataFrame:
    out = holiday_features(time_features(weather_features(df)), calendar)
    return out.select(*feats) if feats else out
