"""Registry of named queries: each key pairs a Spark callable
``(spark, sf_dir) -> DataFrame`` with an optional DuckDB oracle SQL string
over the driver's pre-registered views (events, part, ...)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLE[key] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# DuckDB text of the fixture views (same rows as wattlake.sources.fixtures)

METER_CTE = """meter_fx AS (
  select event_id as row_id, user_id as building_id,
    case event_type when 'view' then 0 when 'click' then 1 when 'purchase' then 2
                    when 'error' then 3 when 'signup' then 3 end as meter,
    cast(date_trunc('hour', ts) as timestamp) as timestamp,
    case when event_id % 20 = 0 then cast(0 as double) else value end as meter_reading
  from events)"""

BUILDING_CTE = """building_fx AS (
  select p_partkey as building_id, cast(p_partkey % 16 as int) as site_id,
    case when p_partkey % 10 < 6 then p_type else p_brand end as primary_use,
    cast(1000 + 37 * (p_partkey % 500) as int) as square_feet,
    case when p_partkey % 16 = 3 or p_partkey % 4 = 1 then null
         else cast(1900 + p_partkey % 117 as double) end as year_built,
    case when p_partkey % 3 = 0 then null else cast(1 + p_size % 12 as double) end as floor_count
  from part)"""

WEATHER_CTE = """weather_fx AS (
  select site_id, timestamp,
    case when k % 7 = 0 then null else floor(lo) / cast(8 as double) - 5 end as air_temperature,
    case when k % 11 = 0 then null else floor(lo) / cast(8 as double) - 6 - k % 5 end as dew_temperature,
    case when site_id = 5 or k % 5 = 0 then null else cast(1000 + k % 40 as double) end as sea_level_pressure,
    case when k % 6 = 0 then null else cast(10 * (k % 37) as double) end as wind_direction,
    case when k % 13 = 0 then null else (k % 24) / cast(2 as double) end as wind_speed
  from (select cast(user_id % 16 as int) as site_id, cast(date_trunc('hour', ts) as timestamp) as timestamp,
               min(value) as lo, min(event_id) as k from events group by 1, 2) w)"""

OFFSETS_CTE = """offsets_fx AS (
  select * from (values (0, -5), (1, 0), (2, -7), (3, -5), (4, -8), (5, 0), (6, -5), (7, -5),
    (8, -5), (9, -6), (10, -7), (11, -5), (12, 0), (13, -6), (14, -5), (15, -5)) t(site_id, utc_offset))"""

COUNTRIES_CTE = """countries_fx AS (
  select * from (values (0, 'US'), (1, 'UK'), (2, 'US'), (3, 'US'), (4, 'US'), (5, 'UK'), (6, 'US'),
    (7, 'CA'), (8, 'US'), (9, 'US'), (10, 'US'), (11, 'CA'), (12, 'IE'), (13, 'US'), (14, 'US'),
    (15, 'US')) t(site_id, country))"""

# meter rows with their building columns, and the two-model prediction fixture
MB_CTE = """mb as (select m.*, b.site_id, b.primary_use, b.square_feet, b.year_built
                   from meter_fx m left join building_fx b on m.building_id = b.building_id)"""
PRED_CTE = """pred as (select row_id, building_id, meter, timestamp, meter_reading,
                          ln(1 + meter_reading) * 0.9 as pred_a, ln(1 + meter_reading) * 1.1 - 0.25 as pred_b
                   from meter_fx)"""

GRID_START = "timestamp '2024-01-01 00:00:00'"
GRID_END = "timestamp '2024-01-30 23:00:00'"

# weather shifted to local time and reindexed onto the 720-hour interval
LOCAL_GRID_CTE = f"""local_fx AS (
  select w.site_id, w.timestamp + o.utc_offset * interval 1 hour as timestamp,
         w.air_temperature, w.dew_temperature, w.sea_level_pressure, w.wind_direction, w.wind_speed
  from weather_fx w left join offsets_fx o on w.site_id = o.site_id),
grid_fx AS (
  select s.site_id, g.timestamp from (select distinct site_id from local_fx) s,
    (select unnest(generate_series({GRID_START}, {GRID_END}, interval 1 hour)) as timestamp) g),
reindexed_fx AS (
  select g.site_id, g.timestamp, l.air_temperature, l.dew_temperature, l.sea_level_pressure,
         l.wind_direction, l.wind_speed
  from grid_fx g left join local_fx l on g.site_id = l.site_id and g.timestamp = l.timestamp)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


_LOADED = False


def _load_all() -> None:
    global _LOADED
    if _LOADED:
        return
    _LOADED = True
    from wattlake.plans import q_core, q_features, q_io, q_model, q_pipelines, q_profile, q_stream, q_windows  # noqa: F401,E501
