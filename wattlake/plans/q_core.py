"""Registered queries: joins, filters and the minimum end-to-end slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import joins, timeseries
from wattlake.plans.registry import (BUILDING_CTE, METER_CTE, OFFSETS_CTE, WEATHER_CTE, register,
                                     with_ctes)
from wattlake.sources import fixtures as fx


@register("join_building", with_ctes("""
select m.row_id, m.building_id, m.meter, m.timestamp, m.meter_reading,
       b.site_id, b.primary_use, b.square_feet, b.year_built, b.floor_count
from meter_fx m left join building_fx b on m.building_id = b.building_id""", METER_CTE, BUILDING_CTE))
def q_join_building(spark, sf):
    return joins.join_building(fx.meter_readings(spark, sf), fx.buildings(spark, sf))


@register("site_hour_profile", with_ctes("""
select b.site_id, cast(hour(m.timestamp) as int) as hour,
       round(avg(m.meter_reading), 6) as mean_reading,
       round(avg(w.air_temperature), 6) as mean_air_temperature,
       count(*) as n_readings
from meter_fx m left join building_fx b on m.building_id = b.building_id
left join (select w.site_id, w.timestamp + o.utc_offset * interval 1 hour as timestamp, w.air_temperature
           from weather_fx w left join offsets_fx o on w.site_id = o.site_id) w
  on b.site_id = w.site_id and m.timestamp = w.timestamp
group by 1, 2""", METER_CTE, BUILDING_CTE, WEATHER_CTE, OFFSETS_CTE))
def q_site_hour_profile(spark, sf):
    """Minimum slice: meter ⟕ building ⟕ local-time weather -> mean by site and hour."""
    local = timeseries.to_local_time(fx.weather(spark, sf))
    merged = joins.merge_data(fx.meter_readings(spark, sf), local, fx.buildings(spark, sf))
    return (merged.groupBy("site_id", F.hour("timestamp").alias("hour"))
            .agg(F.round(F.avg("meter_reading"), 6).alias("mean_reading"),
                 F.round(F.avg("air_temperature"), 6).alias("mean_air_temperature"),
                 F.count("*").alias("n_readings")))


@register("join_weather", with_ctes("""
select m.row_id, m.building_id, m.meter, m.timestamp, m.meter_reading, b.site_id, b.primary_use,
       b.square_feet, b.year_built, b.floor_count, w.air_temperature, w.dew_temperature,
       w.sea_level_pressure, w.wind_direction, w.wind_speed
from meter_fx m left join building_fx b on m.building_id = b.building_id
left join weather_fx w on b.site_id = w.site_id and m.timestamp = w.timestamp""",
    METER_CTE, BUILDING_CTE, WEATHER_CTE))
def q_join_weather(spark, sf):
    mb = joins.join_building(fx.meter_readings(spark, sf), fx.buildings(spark, sf))
    return joins.join_weather(mb, fx.weather(spark, sf))
