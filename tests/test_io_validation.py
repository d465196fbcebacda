"""Sources, sinks, type narrowing and input validation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.operators import validation as val
from wattlake.session import scratch_dir
from wattlake.sources import io


def test_json_columns_payload(spark):
    payload = ('{"site_id": {"0": 1, "1": 1}, "timestamp": {"0": 1451606400000, "1": "2016-01-01T01:00:00"},'
               ' "air_temperature": {"0": 2.5, "1": null}}')
    df = spark.createDataFrame([(payload,)], "payload string")
    schema = T._parse_datatype_string("site_id int, timestamp timestamp_ntz, air_temperature double")
    out = sorted(io.read_json_columns(df, schema).collect(), key=lambda r: r.row_key)
    assert [r.timestamp for r in out] == [dt.datetime(2016, 1, 1, 0), dt.datetime(2016, 1, 1, 1)]
    assert [r.air_temperature for r in out] == [2.5, None]


def test_json_columns_round_trip(spark):
    rows = [(s, dt.datetime(2024, 1, 1, h), float(h) if h % 3 else None) for s in (0, 1) for h in range(5)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, v double")
    payloads = io.to_json_columns(df.withColumn("g", F.col("site_id")), ["g"], "timestamp", df.columns)
    back = io.read_json_columns(payloads, df.schema).drop("row_key")
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_round_trip_keeps_nulls_and_timestamps(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 5), None), (2, dt.datetime(2024, 1, 2, 6), 1.25)]
    df = spark.createDataFrame(rows, "id bigint, timestamp timestamp_ntz, v double")
    path = io.write_csv(df, scratch_dir(spark, "t-csv"))
    assert sorted(io.read_csv(spark, path, "id bigint, timestamp timestamp_ntz, v double").collect()) == sorted(
        df.collect())


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, -5, 70000, 1.5)], "a bigint, b bigint, c bigint, d bigint, x double")
    t = dict(io.narrow_types(df).dtypes)
    assert t == {"a": "smallint", "b": "int", "c": "bigint", "d": "bigint", "x": "float"}


def test_verify_written_detects_loss(spark):
    df = spark.range(10)
    rep = io.verify_written(df, df.where("id < 8")).first()
    assert (rep.rows_written, rep.rows_read, rep.missing, rep.extra) == (10, 8, 2, 0)


def test_validation_counts_and_raises(spark):
    meter = spark.createDataFrame([(1, 0, dt.datetime(2024, 1, 1)), (2000, 5, dt.datetime(2024, 1, 1))],
                                  "building_id int, meter int, timestamp timestamp_ntz")
    rep = {r.rule: r.violations for r in val.validate_meter(meter).collect()}
    assert rep["building_id <= 1448"] == 1 and rep["meter <= 3"] == 1 and rep["meter >= 0"] == 0
    weather = spark.createDataFrame([(0, dt.datetime(2024, 1, 1), None, 1.0, 1000.0, 1.0, 10.0)],
                                    "site_id int, timestamp timestamp_ntz, air_temperature double, "
                                    "dew_temperature double, sea_level_pressure double, wind_speed double, "
                                    "wind_direction double")
    with pytest.raises(AssertionError, match="building_id"):
        val.validate_inputs(meter, weather, raise_on_error=True)
    bad_cols = weather.withColumn("wind_speed", F.lit("x"))
    with pytest.raises(AssertionError, match="not supported"):
        val.validate_inputs(meter, bad_cols, raise_on_error=True)


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "Asia/Kolkata"])
def test_results_do_not_depend_on_session_time_zone(spark, tz):
    from conftest import SF_SMALL
    from wattlake.plans.registry import queries
    keys = ["reindex_time", "time_slice", "weather_pipeline", "holiday_flag", "resample_mean"]
    base = {k: sorted(queries()[k](spark, SF_SMALL).collect()) for k in keys}
    payload = '{"site_id": {"0": 1}, "timestamp": {"0": 1451606400000}, "air_temperature": {"0": 2.5}}'
    schema = T._parse_datatype_string("site_id int, timestamp timestamp_ntz, air_temperature double")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for k in keys:
            assert sorted(queries()[k](spark, SF_SMALL).collect()) == base[k], k
        r = io.read_json_columns(spark.createDataFrame([(payload,)], "payload string"), schema).first()
        assert r.timestamp == dt.datetime(2016, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
