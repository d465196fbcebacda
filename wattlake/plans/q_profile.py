"""Registered queries: profiling aggregates (inventory section 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import profiling as pr
from wattlake.operators import timeseries as ts
from wattlake.plans.common import round_doubles
from wattlake.plans.registry import (BUILDING_CTE, LOCAL_GRID_CTE, METER_CTE, OFFSETS_CTE,
                                     WEATHER_CTE, register, with_ctes)
from wattlake.sources import fixtures as fx

W_MEASURES = ["air_temperature", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed"]
W_COLS = ["site_id", "timestamp"] + W_MEASURES
W_TYPES = {"site_id": "int", "timestamp": "timestamp_ntz", **{c: "double" for c in W_MEASURES}}
B_COLS = ["building_id", "site_id", "primary_use", "square_feet", "year_built", "floor_count"]
B_TYPES = {"building_id": "bigint", "site_id": "int", "primary_use": "string", "square_feet": "int",
           "year_built": "double", "floor_count": "double"}


def local_reindexed(spark, sf):
    w = ts.to_local_time(fx.weather(spark, sf))
    return ts.reindex_time(w, fx.INTERVAL_START, fx.INTERVAL_END)


@register("column_types", with_ctes("\nunion all\n".join(
    f"select '{c}' as \"column\", '{B_TYPES[c]}' as dtype, count({c}) as non_null from building_fx"
    for c in B_COLS), BUILDING_CTE))
def q_column_types(spark, sf):
    return pr.column_types(fx.buildings(spark, sf))


_num = {"site_id", *W_MEASURES}


def _stats_sql(c):
    if c in _num:
        return (f"select '{c}' as \"column\", count({c}) as count, count(*) - count({c}) as missing, "
                f"round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, "
                f"round(cast(min({c}) as double), 6) as min, round(cast(max({c}) as double), 6) as max, "
                f"'{W_TYPES[c]}' as dtype from weather_fx")
    return (f"select '{c}' as \"column\", count({c}) as count, count(*) - count({c}) as missing, "
            f"cast(null as double) as mean, cast(null as double) as std, cast(null as double) as min, "
            f"cast(null as double) as max, '{W_TYPES[c]}' as dtype from weather_fx")


@register("column_stats", with_ctes("\nunion all\n".join(_stats_sql(c) for c in W_COLS), WEATHER_CTE))
def q_column_stats(spark, sf):
    return round_doubles(pr.column_stats(fx.weather(spark, sf)))


_DESC = W_MEASURES


@register("describe", with_ctes("\nunion all\n".join(
    f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean, "
    f"round(stddev_samp({c}), 6) as std, round(min({c}), 6) as min, "
    f"round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50, "
    f"round(quantile_cont({c}, 0.75), 6) as p75, round(max({c}), 6) as max from weather_fx"
    for c in _DESC), WEATHER_CTE))
def q_describe(spark, sf):
    return round_doubles(pr.describe(fx.weather(spark, sf), _DESC))


@register("missing_summary", with_ctes("\nunion all\n".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as missing, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2) as pct_missing from weather_fx"
    for c in W_COLS), WEATHER_CTE))
def q_missing_summary(spark, sf):
    return pr.missing_summary(fx.weather(spark, sf))


@register("missing_by_site", with_ctes(
    "select site_id, count(timestamp) as timestamp, "
    + ", ".join(f"round((count(timestamp) - count({c})) * 100.0 / count(timestamp), 2) as pct_missing_{c}"
                for c in W_MEASURES)
    + " from reindexed_fx group by site_id",
    WEATHER_CTE, OFFSETS_CTE, LOCAL_GRID_CTE))
def q_missing_by_site(spark, sf):
    return pr.missing_by_site(local_reindexed(spark, sf), pct=True)


@register("null_assert", with_ctes("\nunion all\n".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as nulls from building_fx" for c in B_COLS),
    BUILDING_CTE))
def q_null_assert(spark, sf):
    return pr.null_counts(fx.buildings(spark, sf))


@register("duplicate_count", with_ctes("""
select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates
from (select building_id, meter, timestamp, count(*) as n from meter_fx group by 1, 2, 3) g""", METER_CTE))
def q_duplicate_count(spark, sf):
    return pr.duplicate_count(fx.meter_readings(spark, sf), ["building_id", "meter", "timestamp"])


@register("expected_gap", with_ctes("""
select count(*) as n_keys, cast(sum(n) as bigint) as n_readings,
       cast(count(*) * 720 - sum(n) as bigint) as missing_readings
from (select building_id, meter, count(*) as n from meter_fx group by 1, 2) g""", METER_CTE))
def q_expected_gap(spark, sf):
    return pr.expected_gap(fx.meter_readings(spark, sf), ["building_id", "meter"], fx.INTERVAL_HOURS)


@register("missing_readings_report", with_ctes("""
select scope, cast(n_missing as bigint) as n_missing, cast(n_total as bigint) as n_total,
       cast((n_missing * 100) // n_total as bigint) as pct from parts""", METER_CTE, """f as (
  select building_id, meter, cast(count(timestamp) <> 720 as int) as short from meter_fx group by 1, 2)""",
    """parts as (
  select 'buildings' as scope, sum(short) as n_missing, count(*) as n_total
    from (select building_id, max(short) as short from f group by 1) b
  union all select 'meters', sum(short), count(*) from f
  union all select case meter when 0 then 'electricity' when 1 then 'chilledwater'
                              when 2 then 'steam' when 3 then 'hotwater' end,
                   sum(short), count(*) from f group by meter)"""))
def q_missing_readings_report(spark, sf):
    return pr.missing_readings_report(fx.meter_readings(spark, sf), fx.INTERVAL_HOURS)


@register("group_count_sum", with_ctes("""
select primary_use, count(*) as count, cast(sum(square_feet) as bigint) as sum_square_feet,
       round(count(*) * 100.0 / (select count(*) from building_fx), 4) as pct
from building_fx group by 1""", BUILDING_CTE))
def q_group_count_sum(spark, sf):
    return pr.group_counts(fx.buildings(spark, sf), ["primary_use"], "square_feet")


@register("group_nunique", with_ctes("""
select meter, count(distinct building_id) as n_building_id from meter_fx group by 1""", METER_CTE))
def q_group_nunique(spark, sf):
    return pr.group_nunique(fx.meter_readings(spark, sf), ["meter"], "building_id")


@register("histogram_of_counts", with_ctes("""
select n_meter, count(*) as n_building_id
from (select building_id, count(distinct meter) as n_meter from meter_fx group by 1) g group by 1""",
    METER_CTE))
def q_histogram_of_counts(spark, sf):
    return pr.count_of_counts(fx.meter_readings(spark, sf), "building_id", "meter")


@register("group_means", with_ctes(
    "select site_id, " + ", ".join(f"round(avg({c}), 6) as mean_{c}" for c in W_MEASURES)
    + " from weather_fx group by 1", WEATHER_CTE))
def q_group_means(spark, sf):
    return round_doubles(pr.group_means(fx.weather(spark, sf), ["site_id"]))


@register("calendar_profile", with_ctes("""
select cast(isodow(timestamp) - 1 as int) as dayofweek, cast(hour(timestamp) as int) as hour,
       round(avg(meter_reading), 6) as mean_meter_reading
from meter_fx group by 1, 2""", METER_CTE))
def q_calendar_profile(spark, sf):
    return round_doubles(pr.calendar_profile(fx.meter_readings(spark, sf), ("dayofweek", "hour")))


@register("pivot_mean", with_ctes(
    "select cast(hour(timestamp) as int) as hour, "
    + ", ".join(f"round(avg(case when site_id = {s} then air_temperature end), 6) as site_id_{s}"
                for s in range(16))
    + " from local_fx group by 1", WEATHER_CTE, OFFSETS_CTE, LOCAL_GRID_CTE))
def q_pivot_mean(spark, sf):
    w = ts.to_local_time(fx.weather(spark, sf)).withColumn("hour", F.hour("timestamp"))
    return round_doubles(pr.pivot_mean(w, "hour", "site_id", "air_temperature", list(range(16))))


@register("pivot_count", with_ctes("""
select s.site_id, u.primary_use, count(b.building_id) as n
from (select distinct site_id from building_fx) s cross join (select distinct primary_use from building_fx) u
left join building_fx b on b.site_id = s.site_id and b.primary_use = u.primary_use
group by 1, 2""", BUILDING_CTE))
def q_pivot_count(spark, sf):
    """The matrix in long form, empty cells included: a pivot's columns depend on the data."""
    wide = pr.pivot_count(fx.buildings(spark, sf), "site_id", "primary_use")
    return wide.unpivot("site_id", [c for c in wide.columns if c != "site_id"], "primary_use", "n")


_PRESENCE = ["""grid as (select b.building_id, t.meter, t.timestamp, t.pos from (select distinct building_id from meter_fx) b,
  (select meter, timestamp, row_number() over (partition by meter order by timestamp) - 1 as pos
   from (select distinct meter, timestamp from meter_fx) d) t)""",
             "cells as (select building_id, meter, timestamp, max(meter_reading) as v from meter_fx group by all)",
             """presence as (select g.building_id, g.meter, g.timestamp, g.pos, cast(sign(c.v) as int) as presence
  from grid g left join cells c on g.building_id = c.building_id and g.meter = c.meter and g.timestamp = c.timestamp)"""]


@register("presence_map", with_ctes("select building_id, meter, timestamp, presence from presence", METER_CTE, *_PRESENCE))
def q_presence_map(spark, sf):
    return pr.presence_map(fx.meter_readings(spark, sf))


@register("presence_runs", with_ctes("""
select building_id, meter, presence, min(pos) as first, max(pos) as last, count(*) as hours
from (select *, sum(cut) over (partition by building_id, meter order by pos) as run
      from (select *, cast(presence is distinct from lag(presence) over w or pos = 0 as int) as cut
            from presence window w as (partition by building_id, meter order by pos)) p) q
group by building_id, meter, presence, run""", METER_CTE, *_PRESENCE))
def q_presence_runs(spark, sf):
    return pr.presence_runs(fx.meter_readings(spark, sf))


@register("resample_mean", with_ctes("""
select g.meter, g.period, round(m.mean_meter_reading, 6) as mean_meter_reading
from (select k.meter, unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-30', interval 1 day))
             as period from (select distinct meter from meter_fx) k) g
left join (select meter, cast(cast(timestamp as date) as timestamp) as period, avg(meter_reading) as mean_meter_reading
           from meter_fx where timestamp >= timestamp '2024-01-01' and timestamp < timestamp '2024-01-31'
           group by 1, 2) m on g.meter = m.meter and g.period = m.period""", METER_CTE))
def q_resample_mean(spark, sf):
    return round_doubles(pr.resample_mean(fx.meter_readings(spark, sf), "day", ["meter"], "meter_reading",
                                          fx.INTERVAL_START, fx.INTERVAL_END))


@register("resample_month", with_ctes("""
select g.meter, g.period, round(m.mean_meter_reading, 6) as mean_meter_reading
from (select distinct meter, timestamp '2024-01-31' as period from meter_fx) g
left join (select meter, cast(last_day(cast(timestamp as date)) as timestamp) as period, avg(meter_reading) as mean_meter_reading
           from meter_fx where timestamp >= timestamp '2024-01-01' and timestamp < timestamp '2024-01-31'
           group by 1, 2) m on g.meter = m.meter and g.period = m.period""", METER_CTE))
def q_resample_month(spark, sf):
    return round_doubles(pr.resample_mean(fx.meter_readings(spark, sf), "month", ["meter"], "meter_reading",
                                          fx.INTERVAL_START, fx.INTERVAL_END))


_IQR_SQL = """q as (select quantile_cont(meter_reading, 0.25) as q25, quantile_cont(meter_reading, 0.75) as q75
      from meter_fx)"""


@register("outlier_thresholds", with_ctes("""
select 'iqr' as stat, round(q25 - (q75 - q25) * 50, 6) as lower, round(q75 + (q75 - q25) * 50, 6) as upper from q
union all
select 'std', round(avg(meter_reading) - stddev_samp(meter_reading) * 3, 6),
       round(avg(meter_reading) + stddev_samp(meter_reading) * 3, 6) from meter_fx""", METER_CTE, _IQR_SQL))
def q_outlier_thresholds(spark, sf):
    m = fx.meter_readings(spark, sf)
    iqr = pr.outlier_thresholds(m, "meter_reading", "iqr", 50).select(F.lit("iqr").alias("stat"), "*")
    std = pr.outlier_thresholds(m, "meter_reading", "std", 3).select(F.lit("std").alias("stat"), "*")
    return round_doubles(iqr.unionByName(std))


@register("outlier_rate", with_ctes("""
select count(*) filter (where meter_reading > (select avg(meter_reading) + stddev_samp(meter_reading) * 3
                                               from meter_fx)) as outliers,
       count(*) as total,
       round(count(*) filter (where meter_reading > (select avg(meter_reading) + stddev_samp(meter_reading) * 3
                                                     from meter_fx)) * 100.0 / count(*), 2) as pct
from meter_fx""", METER_CTE))
def q_outlier_rate(spark, sf):
    m = fx.meter_readings(spark, sf)
    upper = pr.outlier_thresholds(m, "meter_reading", "std", 3).select("upper").scalar()
    return pr.outlier_rate(m, "meter_reading", upper)


@register("outlier_filter", with_ctes("""
select m.* from meter_fx m where meter_reading <= (select q75 + (q75 - q25) * 50 from q)""",
    METER_CTE, _IQR_SQL))
def q_outlier_filter(spark, sf):
    m = fx.meter_readings(spark, sf)
    upper = pr.outlier_thresholds(m, "meter_reading", "iqr", 50).select("upper").scalar()
    from wattlake.operators.filters import remove_outliers
    return remove_outliers(m, "meter_reading", upper)


@register("value_counts", with_ctes("""
select primary_use, count(*) as count, count(*) / (select count(*) from building_fx) as share,
       count(*) / (select count(*) from building_fx) < 0.05 as rare
from building_fx group by 1""", BUILDING_CTE))
def q_value_counts(spark, sf):
    return pr.value_counts(fx.buildings(spark, sf), "primary_use", 0.05)


@register("distinct_values", with_ctes("select distinct meter from meter_fx", METER_CTE))
def q_distinct_values(spark, sf):
    return pr.distinct_values(fx.meter_readings(spark, sf), "meter")


@register("histogram", with_ctes("""
select b.bin, round(lo + b.bin * (hi - lo) / 20, 6) as lower, round(lo + (b.bin + 1) * (hi - lo) / 20, 6) as upper,
       coalesce(c.count, 0) as count
from (select cast(unnest(generate_series(0, 19)) as int) as bin) b cross join mm
left join (select cast(least(floor((meter_reading - (select lo from mm)) / (((select hi from mm) - (select lo from mm)) / 20)), 19) as int) as bin,
                  count(*) as count from meter_fx where meter_reading is not null group by 1) c on b.bin = c.bin""",
    METER_CTE, "mm as (select cast(min(meter_reading) as double) as lo, cast(max(meter_reading) as double) as hi from meter_fx)"))
def q_histogram(spark, sf):
    return round_doubles(pr.histogram(fx.meter_readings(spark, sf), "meter_reading", 20))


@register("variance_flags", with_ctes("\nunion all\n".join(
    f"select '{c}' as \"column\", round(var_samp({c}), 6) as variance, var_samp({c}) = 0 as constant, "
    f"var_samp({c}) < 0.01 as quasiconstant from weather_fx" for c in ["site_id"] + W_MEASURES), WEATHER_CTE))
def q_variance_flags(spark, sf):
    return round_doubles(pr.variance_flags(fx.weather(spark, sf)))


_DUP_COLS = B_COLS + ["site_code"]
_DUP_TYPES = {**B_TYPES, "site_code": "int"}


def _dup_sql():
    parts = []
    for i, a in enumerate(_DUP_COLS):
        for b in _DUP_COLS[i + 1:]:
            if _DUP_TYPES[a] == _DUP_TYPES[b]:
                parts.append(f"select '{a}' as col1, '{b}' as col2, "
                             f"coalesce(bool_and({a} is not distinct from {b}), true) as equal from dup_src")
            else:
                parts.append(f"select '{a}' as col1, '{b}' as col2, false as equal")
    return "\nunion all\n".join(parts)


@register("duplicate_features", with_ctes(_dup_sql(), BUILDING_CTE,
    "dup_src as (select *, cast(building_id % 16 as int) as site_code from building_fx)"))
def q_duplicate_features(spark, sf):
    b = fx.buildings(spark, sf).withColumn("site_code", (F.col("building_id") % 16).cast("int"))
    return pr.duplicate_features(b)


_CORR_COLS = W_MEASURES


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i:]:
            if a == b:
                parts.append(f"select '{a}' as col1, '{b}' as col2, 1.0 as corr")
            else:
                parts.append(f"select '{a}' as col1, '{b}' as col2, round(corr({a}, {b}), 6) as corr "
                             f"from weather_fx")
    return "\nunion all\n".join(parts)


@register("correlation_matrix", with_ctes(_corr_sql(), WEATHER_CTE))
def q_correlation_matrix(spark, sf):
    return round_doubles(pr.correlation_matrix(fx.weather(spark, sf), _CORR_COLS))


@register("correlated_features", with_ctes(
    "select * from (" + _corr_sql() + ") c where col1 <> col2 and corr >= 0.5", WEATHER_CTE))
def q_correlated_features(spark, sf):
    return pr.correlated_features(round_doubles(pr.correlation_matrix(fx.weather(spark, sf), _CORR_COLS)), 0.5)


_TC = ["square_feet", "year_built", "floor_count", *W_MEASURES]  # every numeric column of the merged table


@register("target_correlation", with_ctes("\nunion all\n".join(
    f"select '{c}' as feature, round(corr({c}, meter_reading), 6) as corr, "
    f"corr({c}, meter_reading) > 0.1 as selected from mbw" for c in _TC),
    METER_CTE, BUILDING_CTE, WEATHER_CTE,
    """mbw as (select m.meter_reading, b.*, w.* exclude (site_id, timestamp)
               from meter_fx m left join building_fx b on m.building_id = b.building_id
               left join weather_fx w on b.site_id = w.site_id and m.timestamp = w.timestamp)"""))
def q_target_correlation(spark, sf):
    from wattlake.operators.joins import merge_data
    mbw = merge_data(fx.meter_readings(spark, sf), fx.weather(spark, sf), fx.buildings(spark, sf))
    tc = pr.target_correlation(mbw, "meter_reading", _TC, threshold=None)
    return round_doubles(tc.withColumn("selected", F.col("corr") > 0.1))


@register("interval_bounds", with_ctes(
    "select min(timestamp) as start, max(timestamp) as \"end\" from weather_fx", WEATHER_CTE))
def q_interval_bounds(spark, sf):
    return pr.time_bounds(fx.weather(spark, sf))


@register("missing_by_site_counts", with_ctes(
    "select site_id, count(timestamp) as timestamp, "
    + ", ".join(f"count(timestamp) - count({c}) as missing_{c}" for c in W_MEASURES)
    + " from reindexed_fx group by site_id",
    WEATHER_CTE, OFFSETS_CTE, LOCAL_GRID_CTE))
def q_missing_by_site_counts(spark, sf):
    return pr.missing_by_site(local_reindexed(spark, sf), pct=False)
