"""Building-energy tables derived from the driver's parquet files.

The reference's own inputs (meter readings, site weather, building
metadata) are not shipped, so each is derived from a driver table with
plain DataFrame expressions.  Everything is lazy: Catalyst prunes the
driver columns and pushes the filters into the parquet scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: fixture interval (720 hours of January 2024) -------------
INTERVAL_START = dt.datetime(2024, 1, 1, 0, 0, 0)
INTERVAL_END = dt.datetime(2024, 1, 30, 23, 0, 0)
INTERVAL_HOURS = 720
# --- end fixed values -------------------------------------------------------


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy scan.  The DataFrame (file listing and
    footer schema) is reused within a session; the data is read by each
    query's own plan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _view(fn):
    """Build a fixture's lazy plan once per session and directory (like a
    temp view): the Python-side construction costs hundreds of JVM calls;
    the data is still scanned by every query's own plan."""
    import functools

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (fn.__name__, id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in _TABLES:
            _TABLES[key] = fn(spark, sf_dir)
        return _TABLES[key]
    return wrapper


def hour_floor(ts: Column) -> Column:
    """Truncate a timestamp_ntz to the hour without touching a time zone."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


@_view
def meter_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly meter readings: row_id, building_id, meter, timestamp, meter_reading."""
    ev = table(spark, sf_dir, "events")
    meter = (F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1)
             .when(F.col("event_type") == "purchase", 2)
             .when(F.col("event_type").isin("error", "signup"), 3))
    return (ev
            .select(F.col("event_id").alias("row_id"),
                    F.col("user_id").alias("building_id"),
                    meter.alias("meter"),
                    hour_floor(F.col("ts")).alias("timestamp"),
                    F.when(F.col("event_id") % 20 == 0, F.lit(0.0))
                    .otherwise(F.col("value")).alias("meter_reading")))


@_view
def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building metadata: building_id, site_id, primary_use, square_feet, year_built, floor_count."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("building_id"),
        (k % 16).cast("int").alias("site_id"),
        F.when(k % 10 < 6, F.col("p_type")).otherwise(F.col("p_brand")).alias("primary_use"),
        (F.lit(1000) + F.lit(37) * (k % 500)).cast("int").alias("square_feet"),
        F.when((k % 16 == 3) | (k % 4 == 1), F.lit(None).cast("double"))
        .otherwise((F.lit(1900) + k % 117).cast("double")).alias("year_built"),
        F.when(k % 3 == 0, F.lit(None).cast("double"))
        .otherwise((F.lit(1) + F.col("p_size") % 12).cast("double")).alias("floor_count"),
    )


@_view
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly site weather, unique per (site_id, timestamp)."""
    ev = table(spark, sf_dir, "events")
    w = (ev.groupBy((F.col("user_id") % 16).cast("int").alias("site_id"),
                    hour_floor(F.col("ts")).alias("timestamp"))
         .agg(F.min("value").alias("lo"), F.min("event_id").alias("k")))
    k, lo, site = F.col("k"), F.col("lo"), F.col("site_id")
    null = F.lit(None).cast("double")
    return w.select(
        "site_id", "timestamp",
        F.when(k % 7 == 0, null).otherwise(F.floor(lo) / F.lit(8.0) - 5).alias("air_temperature"),
        F.when(k % 11 == 0, null).otherwise(F.floor(lo) / F.lit(8.0) - 6 - k % 5).alias("dew_temperature"),
        F.when((site == 5) | (k % 5 == 0), null).otherwise((F.lit(1000) + k % 40).cast("double"))
        .alias("sea_level_pressure"),
        F.when(k % 6 == 0, null).otherwise((F.lit(10) * (k % 37)).cast("double")).alias("wind_direction"),
        F.when(k % 13 == 0, null).otherwise((k % 24) / F.lit(2.0)).alias("wind_speed"),
    )


@_view
def scoring_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring-period meter rows (no reading): row_id, building_id, meter, timestamp."""
    return meter_readings(spark, sf_dir).drop("meter_reading")


@_view
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two model outputs per row: pred_a, pred_b (some negative, for clipping)."""
    m = meter_readings(spark, sf_dir)
    base = F.log1p(F.col("meter_reading"))
    return m.select("row_id", "building_id", "meter", "timestamp", "meter_reading",
                    (base * 0.9).alias("pred_a"), (base * 1.1 - 0.25).alias("pred_b"))


def spline_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per site of the weather table, the interval grid with a cubic-polynomial
    value nulled on two hours of every seven (first and last hour kept).

    Columns: site_id, timestamp, h, value, truth."""
    from wattlake.operators.timeseries import site_hour_grid

    grid = site_hour_grid(weather(spark, sf_dir), INTERVAL_START, INTERVAL_END)
    h = (F.datediff(F.to_date(F.col("timestamp")), F.lit(INTERVAL_START.date())) * 24
         + F.hour(F.col("timestamp")))
    u = h / F.lit(float(INTERVAL_HOURS))
    truth = F.lit(1.0) + F.col("site_id") + 2 * u - 3 * u * u + u * u * u
    return (grid.withColumn("h", h)
            .withColumn("truth", truth)
            .withColumn("value", F.when((F.col("h") % 7).isin(3, 4) & (F.col("h") > 0)
                                        & (F.col("h") < INTERVAL_HOURS - 1), F.lit(None))
                        .otherwise(F.col("truth"))))
