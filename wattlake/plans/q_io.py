"""Registered queries: scans, sinks, schema operations (inventory 2.1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.constants import MODEL_FEATURES
from wattlake.plans.registry import BUILDING_CTE, METER_CTE, WEATHER_CTE, register, with_ctes
from wattlake.session import scratch_dir
from wattlake.sources import fixtures as fx
from wattlake.sources import io

METER_SCHEMA = "row_id bigint, building_id bigint, meter int, timestamp timestamp_ntz, meter_reading double"
BUILDING_SCHEMA = ("building_id bigint, site_id int, primary_use string, square_feet int, "
                   "year_built double, floor_count double")
WEATHER_SCHEMA = ("site_id int, timestamp timestamp_ntz, air_temperature double, dew_temperature double, "
                  "sea_level_pressure double, wind_direction double, wind_speed double")

M_SQL = with_ctes("select * from meter_fx", METER_CTE)
B_SQL = with_ctes("select * from building_fx", BUILDING_CTE)
W_SQL = with_ctes("select * from weather_fx", WEATHER_CTE)


@register("scan_csv", M_SQL)
def q_scan_csv(spark, sf):
    path = io.write_csv(fx.meter_readings(spark, sf), scratch_dir(spark, "meter-csv"))
    return io.read_csv(spark, path, METER_SCHEMA)


@register("sink_csv", B_SQL)
def q_sink_csv(spark, sf):
    path = io.write_csv(fx.buildings(spark, sf), scratch_dir(spark, "building-csv"))
    return io.read_csv(spark, path, BUILDING_SCHEMA)


@register("scan_table", M_SQL)
def q_scan_table(spark, sf):
    path = io.write_table(fx.meter_readings(spark, sf), scratch_dir(spark, "meter-parquet"))
    return io.read_table(spark, path)


@register("sink_table", W_SQL)
def q_sink_table(spark, sf):
    path = io.write_table(fx.weather(spark, sf), scratch_dir(spark, "weather-parquet"))
    return io.read_table(spark, path)


@register("sink_partitioned", with_ctes("select * from meter_fx where meter = 1", METER_CTE))
def q_sink_partitioned(spark, sf):
    path = io.write_table(fx.meter_readings(spark, sf), scratch_dir(spark, "meter-by-type"), by=["meter"])
    # partition filter: only the meter=1 folder is listed and read
    return io.read_table(spark, path).where(F.col("meter") == 1).select(
        "row_id", "building_id", "meter", "timestamp", "meter_reading")


@register("scan_json", W_SQL)
def q_scan_json(spark, sf):
    """Column-oriented JSON payloads (one per site-day) parsed back to rows."""
    w = fx.weather(spark, sf)
    keyed = w.withColumns({"grp_site": F.col("site_id"), "grp_day": F.to_date("timestamp")})
    payloads = io.to_json_columns(keyed, ["grp_site", "grp_day"], "timestamp", w.columns)
    path = scratch_dir(spark, "weather-json")
    payloads.write.mode("overwrite").parquet(path)
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(WEATHER_SCHEMA)
    return io.read_json_columns(spark.read.parquet(path), schema).drop("row_key")


@register("scan_json_lines", W_SQL)
def q_scan_json_lines(spark, sf):
    path = scratch_dir(spark, "weather-jsonl")
    fx.weather(spark, sf).write.mode("overwrite").json(path)
    return io.read_json_lines(spark, path, WEATHER_SCHEMA)


@register("roundtrip_check", with_ctes(
    "select count(*) as rows_written, count(*) as rows_read, cast(0 as bigint) as missing, "
    "cast(0 as bigint) as extra from meter_fx", METER_CTE))
def q_roundtrip_check(spark, sf):
    m = fx.meter_readings(spark, sf)
    path = io.write_table(m, scratch_dir(spark, "roundtrip"))
    return io.verify_written(m, io.read_table(spark, path))


@register("narrow_types", with_ctes("""
select cast(building_id as int) as building_id, cast(site_id as smallint) as site_id, primary_use,
       cast(square_feet as int) as square_feet, cast(year_built as float) as year_built,
       cast(floor_count as float) as floor_count from building_fx""", BUILDING_CTE))
def q_narrow_types(spark, sf):
    return io.narrow_types(fx.buildings(spark, sf))


@register("cast_columns", with_ctes("""
select site_id, timestamp, air_temperature, dew_temperature, sea_level_pressure,
       cast(trunc(wind_direction) as int) as wind_direction, wind_speed,
       cast(site_id as varchar) as site_label from weather_fx""", WEATHER_CTE))
def q_cast_columns(spark, sf):
    w = fx.weather(spark, sf).withColumn("site_label", F.col("site_id"))
    return io.cast_columns(w, {"wind_direction": "int", "site_label": "string"})


@register("rename_columns", with_ctes("""
select row_id as w_row_id, building_id as w_building_id, meter as w_meter, timestamp,
       meter_reading as w_reading from meter_fx""", METER_CTE))
def q_rename_columns(spark, sf):
    m = io.rename_columns(fx.meter_readings(spark, sf), {"meter_reading": "reading"})
    return io.rename_columns(m, prefix="w_", keep=["timestamp"])


_FEATS = ["building_id", "primary_use", "square_feet", "year_built", "meter"]


@register("select_features", with_ctes("""
select m.building_id, b.primary_use, b.square_feet, b.year_built, m.meter
from meter_fx m left join building_fx b on m.building_id = b.building_id""", METER_CTE, BUILDING_CTE))
def q_select_features(spark, sf):
    from wattlake.operators.joins import join_building
    mb = join_building(fx.meter_readings(spark, sf), fx.buildings(spark, sf))
    feats = [c for c in MODEL_FEATURES if c in _FEATS]
    return io.select_features(mb, feats)


@register("drop_columns", with_ctes("select site_id, timestamp, air_temperature, dew_temperature, "
                                    "sea_level_pressure, wind_direction, wind_speed from weather_fx",
                                    WEATHER_CTE))
def q_drop_columns(spark, sf):
    w = fx.weather(spark, sf).withColumns({"cloud_coverage": F.lit(None).cast("double"),
                                           "precip_depth_1_hr": F.lit(None).cast("double")})
    return io.drop_columns(w, ["cloud_coverage", "precip_depth_1_hr"])
