"""Registered queries: grid, reindex, fills, imputation (2.3, 2.5)."""

from __future__ import annotations


from wattlake.constants import CUBIC_FILL_COLS, LINEAR_FILL_COLS
from wattlake.operators import impute
from wattlake.operators import timeseries as ts
from wattlake.plans.common import round_doubles
from wattlake.plans.registry import (BUILDING_CTE, LOCAL_GRID_CTE, OFFSETS_CTE, WEATHER_CTE, register,
                                     with_ctes)
from wattlake.plans.spline_sql import cubic_ctes
from wattlake.sources import fixtures as fx

W_MEASURES = ["air_temperature", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed"]
LOCAL = (WEATHER_CTE, OFFSETS_CTE, LOCAL_GRID_CTE)
WIN = "partition by site_id order by timestamp"
PREV = f"over ({WIN} rows between unbounded preceding and current row)"
NEXT = f"over ({WIN} rows between current row and unbounded following)"


def local_reindexed(spark, sf):
    w = ts.to_local_time(fx.weather(spark, sf))
    return ts.reindex_time(w, fx.INTERVAL_START, fx.INTERVAL_END)


@register("cross_grid", with_ctes("select site_id, timestamp from grid_fx", *LOCAL))
def q_cross_grid(spark, sf):
    return ts.site_hour_grid(ts.to_local_time(fx.weather(spark, sf)), fx.INTERVAL_START, fx.INTERVAL_END)


@register("reindex_time", with_ctes("select * from reindexed_fx", *LOCAL))
def q_reindex_time(spark, sf):
    return local_reindexed(spark, sf)


@register("forward_fill", with_ctes(
    "select site_id, timestamp, " + ", ".join(f"last_value({c} ignore nulls) {PREV} as {c}" for c in W_MEASURES)
    + " from reindexed_fx", *LOCAL))
def q_forward_fill(spark, sf):
    return ts.forward_fill(local_reindexed(spark, sf), W_MEASURES)


@register("backward_fill", with_ctes(
    "select site_id, timestamp, " + ", ".join(f"first_value({c} ignore nulls) {NEXT} as {c}" for c in W_MEASURES)
    + " from reindexed_fx", *LOCAL))
def q_backward_fill(spark, sf):
    return ts.backward_fill(local_reindexed(spark, sf), W_MEASURES)


def _linear_sql(cols, src="p"):
    out = []
    for c in cols:
        pv = f"last_value({c} ignore nulls) {PREV}"
        pp = f"last_value(case when {c} is not null then pos end ignore nulls) {PREV}"
        nv = f"first_value({c} ignore nulls) {NEXT}"
        np_ = f"first_value(case when {c} is not null then pos end ignore nulls) {NEXT}"
        out.append(f"round(case when {c} is not null then {c} "
                   f"when ({pp}) is not null and ({np_}) is not null "
                   f"then ({pv}) + (({nv}) - ({pv})) * (pos - ({pp})) / (({np_}) - ({pp})) "
                   f"else coalesce({pv}, {nv}) end, 6) as {c}")
    return ", ".join(out)


LIN_SRC = f"p as (select *, row_number() over ({WIN}) as pos from reindexed_fx)"


@register("interpolate_linear", with_ctes(
    "select site_id, timestamp, " + _linear_sql(W_MEASURES) + " from p", *LOCAL, LIN_SRC))
def q_interpolate_linear(spark, sf):
    return round_doubles(ts.interpolate_linear(local_reindexed(spark, sf), W_MEASURES))


def with_recursive(body: str, *ctes: str) -> str:
    return with_ctes(body, *ctes).replace("WITH ", "WITH RECURSIVE ", 1)


CUBIC = [*LOCAL, *cubic_ctes(CUBIC_FILL_COLS)]


@register("interpolate_cubic", with_recursive(
    "select site_id, timestamp, " + ", ".join(f"round({c}, 6) as {c}" for c in CUBIC_FILL_COLS) + " from cubic", *CUBIC))
def q_interpolate_cubic(spark, sf):
    """Splines through the weather's own gaps."""
    d = local_reindexed(spark, sf).select("site_id", "timestamp", *CUBIC_FILL_COLS)
    return round_doubles(ts.interpolate_cubic(d, CUBIC_FILL_COLS))


SPLINE_SQL = with_ctes("""
select site_id, timestamp, round(1 + site_id + 2 * u - 3 * u * u + u * u * u, 6) as value
from (select s.site_id, g.timestamp, (datediff('hour', timestamp '2024-01-01', g.timestamp)) / 720.0 as u
      from (select distinct site_id from weather_fx) s,
           (select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-30 23:00:00',
                                          interval 1 hour)) as timestamp) g) t""", WEATHER_CTE)


@register("interpolate_cubic_closed_form", SPLINE_SQL)
def q_interpolate_cubic_closed_form(spark, sf):
    """Spline fixture: a cubic polynomial with gaps on every site's hours; the not-a-knot spline
    restores it exactly, so the oracle is the closed form."""
    f = fx.spline_fixture(spark, sf).select("site_id", "timestamp", "value")
    return round_doubles(ts.interpolate_cubic(f, ["value"]))


FILL_SQL_BODY = ("select site_id, timestamp, "
                 + ", ".join(f"round(coalesce(last_value({c} ignore nulls) {PREV}, first_value({c} ignore nulls) {NEXT}), 6) "
                             f"as {c}" for c in W_MEASURES) + " from lin")


@register("fill_missing", with_ctes(FILL_SQL_BODY, *LOCAL, LIN_SRC,
                                    "lin as (select site_id, timestamp, "
                                    + _linear_sql(W_MEASURES).replace("round(", "(").replace(", 6) as", ") as")
                                    + " from p)"))
def q_fill_missing(spark, sf):
    """Linear for every measure (the JVM-only plan); cubic columns use the
    linear method here so the oracle can express it."""
    d = ts.fill_missing(local_reindexed(spark, sf), linear_cols=LINEAR_FILL_COLS, cubic_cols=CUBIC_FILL_COLS,
                        cubic_method="linear")
    return round_doubles(d)


@register("fill_missing_chunked", with_ctes(FILL_SQL_BODY, *LOCAL, LIN_SRC,
                                            "lin as (select site_id, timestamp, "
                                            + _linear_sql(W_MEASURES).replace("round(", "(").replace(", 6) as", ") as")
                                            + " from p)"))
def q_fill_missing_chunked(spark, sf):
    """Same fill as ``fill_missing`` with every site's series cut into
    one-day chunks (skew-safe plan); same oracle."""
    d = ts.fill_missing(local_reindexed(spark, sf), linear_cols=LINEAR_FILL_COLS, cubic_cols=CUBIC_FILL_COLS,
                        cubic_method="linear", chunk_hours=24)
    return round_doubles(d)


# cubic for temperatures and pressure, linear for wind, then ffill + bfill
CUBIC_LIN = [*CUBIC, LIN_SRC.replace("p as (", "lp as (", 1).replace("from reindexed_fx", "from cubic"),
             "lin as (select site_id, timestamp, " + ", ".join(CUBIC_FILL_COLS) + ", "
             + _linear_sql(LINEAR_FILL_COLS).replace("round(", "(").replace(", 6) as", ") as") + " from lp)"]


@register("fill_missing_cubic", with_recursive(FILL_SQL_BODY, *CUBIC_LIN))
def q_fill_missing_cubic(spark, sf):
    """Full reference fill: cubic spline for temperatures and pressure."""
    d = ts.fill_missing(local_reindexed(spark, sf), linear_cols=LINEAR_FILL_COLS, cubic_cols=CUBIC_FILL_COLS)
    return round_doubles(d)


@register("fill_missing_cubic_chunked", with_recursive(FILL_SQL_BODY, *CUBIC_LIN))
def q_fill_missing_cubic_chunked(spark, sf):
    """The same fill with every site's series cut into chunks of a week, splines included; same oracle."""
    d = ts.fill_missing(local_reindexed(spark, sf), linear_cols=LINEAR_FILL_COLS, cubic_cols=CUBIC_FILL_COLS,
                        chunk_hours=24 * 7)
    return round_doubles(d)


@register("copy_site_column", with_ctes("""
select f.site_id, f.timestamp, f.air_temperature,
       case when f.site_id = 5 then s.sea_level_pressure else f.sea_level_pressure end as sea_level_pressure
from reindexed_fx f left join (select timestamp, sea_level_pressure from reindexed_fx where site_id = 1) s
  on f.timestamp = s.timestamp""", *LOCAL))
def q_copy_site_column(spark, sf):
    d = local_reindexed(spark, sf).select("site_id", "timestamp", "air_temperature", "sea_level_pressure")
    return ts.copy_site_column(d, "sea_level_pressure", 1, 5)


# --------------------------------------------------------------- imputation

@register("group_median_impute", with_ctes("""
select building_id, site_id, coalesce(year_built, median(year_built) over (partition by site_id)) as year_built
from building_fx""", BUILDING_CTE))
def q_group_median_impute(spark, sf):
    b = fx.buildings(spark, sf).select("building_id", "site_id", "year_built")
    return impute.impute_group_median(b, "year_built", "site_id")


@register("cascade_impute", with_ctes("""
select building_id, site_id, primary_use, cast(trunc(year_built) as int) as year_built from s3""",
    BUILDING_CTE,
    """s1 as (select building_id, site_id, primary_use,
       coalesce(year_built, median(year_built) over (partition by site_id)) as year_built from building_fx)""",
    """s2 as (select building_id, site_id, primary_use,
       coalesce(year_built, median(year_built) over (partition by primary_use)) as year_built from s1)""",
    """s3 as (select building_id, site_id, primary_use,
       coalesce(year_built, median(year_built) over (partition by site_id)) as year_built from s2)"""))
def q_cascade_impute(spark, sf):
    b = fx.buildings(spark, sf).select("building_id", "site_id", "primary_use", "year_built")
    return impute.impute_year_built(b)


@register("missing_indicator", with_ctes(
    "select building_id, cast(year_built is null as int) as missing_year from building_fx", BUILDING_CTE))
def q_missing_indicator(spark, sf):
    b = fx.buildings(spark, sf)
    return impute.missing_flag(b, "year_built", "missing_year").select("building_id", "missing_year")
