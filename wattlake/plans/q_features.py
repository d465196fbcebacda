"""Registered queries: filters (2.2), scalar features (2.7), holidays (2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake import functions as fn
from wattlake.constants import METER_NAMES
from wattlake.operators import filters as flt
from wattlake.operators import features as feat
from wattlake.operators import holidays as hol
from wattlake.operators import timeseries as ts
from wattlake.operators.joins import join_building
from wattlake.plans.common import round_doubles
from wattlake.plans.registry import (BUILDING_CTE, COUNTRIES_CTE, MB_CTE, METER_CTE, OFFSETS_CTE, PRED_CTE,
                                     WEATHER_CTE, register, with_ctes)
from wattlake.sources import fixtures as fx

def mb(spark, sf):
    return join_building(fx.meter_readings(spark, sf), fx.buildings(spark, sf)).drop("floor_count")


# ----------------------------------------------------------------- filters

@register("filter_site", with_ctes("""
select timestamp, air_temperature, dew_temperature, sea_level_pressure, wind_direction, wind_speed
from weather_fx where site_id = 1""", WEATHER_CTE))
def q_filter_site(spark, sf):
    return flt.get_site(fx.weather(spark, sf), 1)


@register("filter_meter_site", with_ctes("select * from mb where site_id = 2 and meter = 1",
                                         METER_CTE, BUILDING_CTE, MB_CTE))
def q_filter_meter_site(spark, sf):
    return flt.where_site_meter(mb(spark, sf), 2, 1)


@register("drop_nonpositive", with_ctes(
    "select * from meter_fx where not coalesce(meter_reading <= 0, false)", METER_CTE))
def q_drop_nonpositive(spark, sf):
    return flt.drop_nonpositive(fx.meter_readings(spark, sf))


@register("range_filter", with_ctes(
    "select * from meter_fx where meter_reading > 0 and meter_reading <= 50", METER_CTE))
def q_range_filter(spark, sf):
    return flt.range_filter(fx.meter_readings(spark, sf), "meter_reading", 0, 50, lower_inclusive=False)


@register("membership", with_ctes(
    "select * from meter_fx where isodow(timestamp) - 1 in (5, 6)", METER_CTE))
def q_membership(spark, sf):
    m = fx.meter_readings(spark, sf)
    return flt.membership(m.withColumn("__dow", F.weekday("timestamp")), "__dow", [5, 6]).drop("__dow")


@register("time_slice", with_ctes("""
select * from meter_fx where timestamp between timestamp '2024-01-05' and timestamp '2024-01-10'""",
                                  METER_CTE))
def q_time_slice(spark, sf):
    return flt.time_slice(fx.meter_readings(spark, sf), "2024-01-05", "2024-01-10")


@register("positional_slice", with_ctes("""
select m.* from meter_fx m join (
  select meter, building_id from (
    select meter, building_id, row_number() over (partition by meter order by building_id) - 1 as rk
    from (select distinct meter, building_id from meter_fx) d) r where rk >= 2 and rk < 5) s
  on m.meter = s.meter and m.building_id = s.building_id""", METER_CTE))
def q_positional_slice(spark, sf):
    return flt.nth_group(fx.meter_readings(spark, sf), 2, 5)


# ----------------------------------------------------------- scalar features

@register("date_parts", with_ctes("""
select row_id, timestamp, cast(dayofyear(timestamp) as int) as dayofyear, cast(month(timestamp) as int) as month,
       cast(day(timestamp) as int) as day, cast(isodow(timestamp) - 1 as int) as dayofweek,
       cast(hour(timestamp) as int) as hour from meter_fx""", METER_CTE))
def q_date_parts(spark, sf):
    return fn.date_parts(fx.meter_readings(spark, sf).select("row_id", "timestamp"))


@register("is_weekend", with_ctes("""
select row_id, cast(isodow(timestamp) >= 6 as int) as is_weekend from meter_fx""", METER_CTE))
def q_is_weekend(spark, sf):
    return fx.meter_readings(spark, sf).select("row_id", fn.is_weekend(F.col("timestamp")).alias("is_weekend"))


@register("to_local_time", with_ctes("""
select w.site_id, w.timestamp + o.utc_offset * interval 1 hour as timestamp, w.air_temperature,
       w.dew_temperature, w.sea_level_pressure, w.wind_direction, w.wind_speed
from weather_fx w left join offsets_fx o on w.site_id = o.site_id""", WEATHER_CTE, OFFSETS_CTE))
def q_to_local_time(spark, sf):
    return ts.to_local_time(fx.weather(spark, sf))


@register("relative_humidity", with_ctes("""
select site_id, timestamp,
  round(6.11 * pow(10.0, 7.5 * dew_temperature / (237.3 + dew_temperature)) * 100
        / (6.11 * pow(10.0, 7.5 * air_temperature / (237.3 + air_temperature))), 6) as rel_humidity
from weather_fx""", WEATHER_CTE))
def q_relative_humidity(spark, sf):
    w = fx.weather(spark, sf)
    return round_doubles(w.select("site_id", "timestamp", fn.relative_humidity(
        F.col("air_temperature"), F.col("dew_temperature")).alias("rel_humidity")))


@register("wind_components", with_ctes("""
select site_id, timestamp,
  round(case when wind_direction = 0 then 0.0 else cos(radians(wind_direction)) end, 6) as wind_direction_x,
  round(sin(radians(wind_direction)), 6) as wind_direction_y
from weather_fx""", WEATHER_CTE))
def q_wind_components(spark, sf):
    w = fx.weather(spark, sf).select("site_id", "timestamp", "wind_direction")
    return round_doubles(fn.wind_components(w, drop=True))


@register("sign", with_ctes("select row_id, cast(sign(meter_reading) as int) as sign from meter_fx", METER_CTE))
def q_sign(spark, sf):
    return fx.meter_readings(spark, sf).select("row_id", F.signum("meter_reading").cast("int").alias("sign"))


@register("log_target", with_ctes(
    "select row_id, round(ln(1 + meter_reading), 6) as log_reading from meter_fx", METER_CTE))
def q_log_target(spark, sf):
    m = fx.meter_readings(spark, sf)
    return round_doubles(m.select("row_id", fn.log_target(F.col("meter_reading")).alias("log_reading")))


@register("exp_target", with_ctes(
    "select row_id, round(exp(pred_a) - 1, 6) as reading from pred", METER_CTE, PRED_CTE))
def q_exp_target(spark, sf):
    p = fx.predictions(spark, sf)
    return round_doubles(p.select("row_id", fn.exp_target(F.col("pred_a")).alias("reading")))


@register("clip_negative", with_ctes(
    "select row_id, round(case when pred_b < 0 then 0.0 else pred_b end, 6) as pred_b from pred",
    METER_CTE, PRED_CTE))
def q_clip_negative(spark, sf):
    p = fx.predictions(spark, sf)
    return round_doubles(p.select("row_id", fn.clip_min(F.col("pred_b"), 0.0).alias("pred_b")))


@register("convert_units", with_ctes("""
select row_id, site_id, meter,
  round(case when site_id = 0 and meter = 0 then meter_reading * 0.2931 else meter_reading end, 6) as meter_reading
from mb""", METER_CTE, BUILDING_CTE, MB_CTE))
def q_convert_units(spark, sf):
    d = mb(spark, sf)
    return round_doubles(d.select("row_id", "site_id", "meter", fn.convert_units(
        F.col("meter_reading"), F.col("site_id"), F.col("meter"), 0, 0, "kbtu_to_kwh").alias("meter_reading")))


@register("restore_site0_units", with_ctes("""
select row_id, site_id, meter,
  round(case when site_id = 0 and meter = 0 then meter_reading * 3.4118
             when site_id = 0 and meter = 1 then meter_reading * 12 else meter_reading end, 6) as meter_reading
from mb""", METER_CTE, BUILDING_CTE, MB_CTE))
def q_restore_site0_units(spark, sf):
    d = mb(spark, sf)
    return round_doubles(d.select("row_id", "site_id", "meter", fn.restore_site0_units(
        F.col("meter_reading"), F.col("site_id"), F.col("meter")).alias("meter_reading")))


@register("normalize_by_area", with_ctes("""
select row_id, meter, square_feet,
  round(meter_reading * avg(square_feet) over (partition by meter) / square_feet, 6) as meter_reading
from mb""", METER_CTE, BUILDING_CTE, MB_CTE))
def q_normalize_by_area(spark, sf):
    d = mb(spark, sf).select("row_id", "meter", "square_feet", "meter_reading")
    return round_doubles(feat.normalize_by_area(d, per="meter"))


@register("normalize_by_area_global", with_ctes("""
select row_id, meter, square_feet,
  round(meter_reading * (select avg(square_feet) from mb) / square_feet, 6) as meter_reading
from mb""", METER_CTE, BUILDING_CTE, MB_CTE))
def q_normalize_by_area_global(spark, sf):
    d = mb(spark, sf).select("row_id", "meter", "square_feet", "meter_reading")
    return round_doubles(feat.normalize_by_area(d, per=None))


@register("inverse_target", with_ctes("""
select row_id, meter, square_feet,
  round((exp(pred_a) - 1) * square_feet / avg(square_feet) over (partition by meter), 6) as pred_a
from (select p.row_id, p.meter, p.pred_a, b.square_feet from pred p
      left join building_fx b on p.building_id = b.building_id) t""", METER_CTE, BUILDING_CTE, PRED_CTE))
def q_inverse_target(spark, sf):
    p = join_building(fx.predictions(spark, sf), fx.buildings(spark, sf)).select(
        "row_id", "meter", "square_feet", "pred_a")
    return round_doubles(feat.inverse_target(p, target="pred_a", per="meter"))


@register("blend", with_ctes("""
select row_id,
  round(case when pred_a is null and pred_b is null then null
             else (coalesce(pred_a * 0.5, 0) + coalesce(pred_b * 0.5, 0))
                  / ((case when pred_a is null then 0 else 0.5 end) + (case when pred_b is null then 0 else 0.5 end))
        end, 6) as blend_50_50,
  round(pred_a * 0.4 + pred_b * 0.6, 6) as blend_40_60,
  round(pred_a * 0.25 + pred_b * 0.75, 6) as blend_25_75,
  round(pred_a * 0.9 + pred_b * 0.1, 6) as blend_90_10
from pred""", METER_CTE, PRED_CTE))
def q_blend(spark, sf):
    p = fx.predictions(spark, sf)
    return round_doubles(p.select(
        "row_id", fn.blend({"pred_a": 0.5, "pred_b": 0.5}).alias("blend_50_50"),
        fn.blend({"pred_a": 0.4, "pred_b": 0.6}).alias("blend_40_60"),
        fn.blend({"pred_a": 0.25, "pred_b": 0.75}).alias("blend_25_75"),
        fn.blend({"pred_a": 0.9, "pred_b": 0.1}).alias("blend_90_10")))


@register("country_of_site", with_ctes("""
select b.building_id, b.site_id, c.country from building_fx b left join countries_fx c on b.site_id = c.site_id""",
                                       BUILDING_CTE, COUNTRIES_CTE))
def q_country_of_site(spark, sf):
    b = fx.buildings(spark, sf)
    return b.select("building_id", "site_id", fn.country_of_site(F.col("site_id")).alias("country"))


@register("map_lookup", with_ctes("""
select row_id, meter, case meter when 0 then 'electricity' when 1 then 'chilledwater' when 2 then 'steam'
                                 when 3 then 'hotwater' end as meter_type from meter_fx""", METER_CTE))
def q_map_lookup(spark, sf):
    m = fx.meter_readings(spark, sf)
    return m.select("row_id", "meter", fn.map_lookup(F.col("meter"), METER_NAMES).alias("meter_type"))


# ------------------------------------------------------------------ holidays

def _holiday_sql_ctes(years_sql: str) -> list[str]:
    """DuckDB text of the same rule table and date rules."""
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    vals = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in hol.HOLIDAY_RULES)
    rules = (f"rules as (select * from (values\n    {vals}) t(country, name, kind, month, day, weekday, n, "
             f"\"offset\", observed, first_year, only_year, skip_year))")
    years = f"years as ({years_sql})"
    easter = """easter as (select year, make_date(year, cast((h + l - 7 * m + 114) // 31 as int),
                                    cast((h + l - 7 * m + 114) % 31 + 1 as int)) as easter_date
  from (select year, a, h, l, (a + 11 * h + 22 * l) // 451 as m from (
    select year, a, h, (32 + 2 * e + 2 * i - h - k) % 7 as l from (
      select year, a, e, i, k, (19 * a + b - d - g + 15) % 30 as h from (
        select year, year % 19 as a, year // 100 as b, year % 100 as c, (year // 100) // 4 as d,
               (year // 100) % 4 as e, ((year // 100) - ((year // 100) + 8) // 25 + 1) // 3 as g,
               (year % 100) // 4 as i, (year % 100) % 4 as k from years) s1) s2) s3) s4)"""
    dated = """dated as (
  select r.country, r.name, r.observed as policy,
    case r.kind
      when 'fixed' then make_date(y.year, r.month, r.day)
      when 'nth' then make_date(y.year, r.month, 1)
           + cast((r.weekday - (isodow(make_date(y.year, r.month, 1)) - 1) + 7) % 7 + 7 * (r.n - 1) as int)
      when 'last' then last_day(make_date(y.year, r.month, 1))
           - cast(((isodow(last_day(make_date(y.year, r.month, 1))) - 1) - r.weekday + 7) % 7 as int)
      when 'onbefore' then make_date(y.year, r.month, r.day)
           - cast(((isodow(make_date(y.year, r.month, r.day)) - 1) - r.weekday + 7) % 7 as int)
      when 'easter' then e.easter_date + cast(r."offset" as int)
    end as holiday_date
  from years y join rules r on (r.first_year is null or y.year >= r.first_year)
    and (r.only_year is null or y.year = r.only_year) and (r.skip_year is null or y.year <> r.skip_year)
  join easter e on e.year = y.year)"""
    cal = """calendar as (
  select country, name, holiday_date, false as observed from dated
  union all
  select country, name || ' (Observed)', holiday_date + cast(shift as int), true from (
    select *, case when policy = 'us' and isodow(holiday_date) = 6 then -1
                   when policy = 'us' and isodow(holiday_date) = 7 then 1
                   when policy = 'monday' and isodow(holiday_date) = 6 then 2
                   when policy = 'monday' and isodow(holiday_date) = 7 then 1
                   when policy = 'plus2' and isodow(holiday_date) >= 6 then 2
                   when policy = 'jan2' and isodow(holiday_date) >= 6 then 2
                   when policy = 'jan2' and isodow(holiday_date) = 1 then 1 end as shift
    from dated) o where shift is not null)"""
    return [rules, years, easter, dated, cal]


_YEARS_FROM_METER = """select distinct cast(y + d as int) as year from (select distinct year(timestamp) as y from meter_fx) t,
  (select unnest([-1, 0, 1]) as d) dd"""


@register("holiday_calendar", with_ctes(
    "select country, name, cast(holiday_date as timestamp) as holiday_date, observed from calendar",
    METER_CTE, *_holiday_sql_ctes(_YEARS_FROM_METER)))
def q_holiday_calendar(spark, sf):
    cal = hol.calendar_for(fx.meter_readings(spark, sf))
    return cal.withColumn("holiday_date", F.col("holiday_date").cast("timestamp_ntz"))


# --- fixed values: the holidays of January 2024, the fixture's month, as published ------
_JANUARY_2024 = """january as (select * from (values ('US', date '2024-01-01'), ('US', date '2024-01-15'),
  ('CA', date '2024-01-01'), ('UK', date '2024-01-01'), ('UK', date '2024-01-02'), ('IE', date '2024-01-01')) t(country, holiday_date))"""
# --- end fixed values -------------------------------------------------------


@register("holiday_flag", with_ctes("""
select m.row_id, m.site_id, c.country,
  cast(exists (select 1 from january k where k.country = c.country
                and k.holiday_date = cast(m.timestamp as date)) as int) as is_holiday
from mb m left join countries_fx c on m.site_id = c.site_id""",
    METER_CTE, BUILDING_CTE, MB_CTE, COUNTRIES_CTE, _JANUARY_2024))
def q_holiday_flag(spark, sf):
    d = mb(spark, sf)
    cal = hol.calendar_for(d)
    out = feat.holiday_features(d, cal)
    return out.select("row_id", "site_id", "country", "is_holiday")
