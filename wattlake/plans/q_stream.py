"""Registered query: the row-wise feature steps as a streaming job."""

from __future__ import annotations

from wattlake.operators.holidays import calendar_for
from wattlake.plans.q_features import _YEARS_FROM_METER, _holiday_sql_ctes
from wattlake.plans.registry import BUILDING_CTE, COUNTRIES_CTE, METER_CTE, register, with_ctes
from wattlake.session import scratch_dir
from wattlake.sources import fixtures as fx
from wattlake.streaming import meter_feature_stream, run_available_now


@register("stream_features", with_ctes("""
select m.row_id, m.building_id, m.meter, m.timestamp,
  round(case when b.site_id = 0 and m.meter = 0 then m.meter_reading * 0.2931 else m.meter_reading end, 6)
    as meter_reading,
  b.site_id, b.square_feet, cast(dayofyear(m.timestamp) as int) as dayofyear, cast(hour(m.timestamp) as int) as hour,
  cast(isodow(m.timestamp) >= 6 as int) as is_weekend, c.country,
  cast(exists (select 1 from calendar k where k.country = c.country
               and k.holiday_date = cast(m.timestamp as date)) as int) as is_holiday
from meter_fx m left join building_fx b on m.building_id = b.building_id
left join countries_fx c on b.site_id = c.site_id""", METER_CTE, BUILDING_CTE, COUNTRIES_CTE,
    *_holiday_sql_ctes(_YEARS_FROM_METER)))
def q_stream_features(spark, sf):
    """Meter rows land as parquet files; a streaming query (availableNow)
    enriches them into a sink table, which is read back."""
    from pyspark.sql import functions as F
    src = scratch_dir(spark, "meter-stream-src")
    meter = fx.meter_readings(spark, sf)
    meter.write.mode("overwrite").parquet(src)
    stream = meter_feature_stream(spark, src, fx.buildings(spark, sf), calendar_for(meter))
    out = run_available_now(stream, scratch_dir(spark, "meter-stream-sink"), scratch_dir(spark, "meter-stream-ckpt"))
    res = spark.read.parquet(out)
    return res.withColumn("meter_reading", F.round("meter_reading", 6))


@register("stream_score")
def q_stream_score(spark, sf):
    """Scoring rows arrive as two files; an availableNow stream scores each
    micro-batch with the fitted models into per-batch folders, read back."""
    from wattlake.plans import q_pipelines as qp
    from pyspark.sql import functions as F
    src = scratch_dir(spark, "score-stream-src")
    rows = fx.scoring_meter(spark, sf)
    rows.where(F.col("row_id") % 2 == 0).write.mode("append").parquet(src)  # files that mix the meters
    rows.where(F.col("row_id") % 2 != 0).write.mode("append").parquet(src)
    sink = scratch_dir(spark, "score-stream-sink")
    from wattlake.streaming import score_stream
    score_stream(spark, src, qp.weather_done(spark, sf, "cubic"), fx.buildings(spark, sf), qp.bundle(spark, sf),
                 sink, scratch_dir(spark, "score-stream-ckpt"), weather_rows=qp.weather_bound(spark, sf),
                 max_files_per_trigger=1)
    return spark.read.parquet(sink).select("row_id", "meter_reading")
