"""Registered queries: composite pipelines (2.11) and model fitting /
tuning / scoring (2.9).  Model keys are rows-only checks (iterative
solvers); the deterministic pipelines carry DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import linear, ml, stages
from wattlake.operators.bundle import ModelBundle
from wattlake.plans import linear_sql as lsql
from wattlake.plans import pipelines as pl
from wattlake.plans.common import round_doubles
from wattlake.plans.q_features import _YEARS_FROM_METER, _holiday_sql_ctes
from wattlake.plans.q_windows import CUBIC_LIN, LIN_SRC, LOCAL, NEXT, PREV, W_MEASURES, _linear_sql, with_recursive
from wattlake.plans.registry import BUILDING_CTE, COUNTRIES_CTE, METER_CTE, register, with_ctes
from wattlake.session import scratch_dir, written_once
from wattlake.sources import fixtures as fx

def _weather_ctes(before) -> list[str]:
    """Weather pipeline in DuckDB text: interpolated ``lin`` -> ffill + bfill -> site 1's pressure for site 5."""
    return [
        *before,
        "filled as (select site_id, timestamp, "
        + ", ".join(f"coalesce(last_value({c} ignore nulls) {PREV}, first_value({c} ignore nulls) {NEXT}) as {c}"
                    for c in W_MEASURES) + " from lin)",
        """wp as (select f.site_id, f.timestamp, f.air_temperature, f.dew_temperature,
       case when f.site_id = 5 then s.sea_level_pressure else f.sea_level_pressure end as sea_level_pressure,
       f.wind_direction, f.wind_speed
  from filled f left join (select timestamp, sea_level_pressure from filled where site_id = 1) s
    on f.timestamp = s.timestamp)""",
    ]


FILLED_CTES = _weather_ctes([*LOCAL, LIN_SRC, "lin as (select site_id, timestamp, "
                             + _linear_sql(W_MEASURES).replace("round(", "(").replace(", 6) as", ") as") + " from p)"])
CUBIC_FILLED_CTES = _weather_ctes(CUBIC_LIN)
_WEATHER_SQL = "select site_id, timestamp, " + ", ".join(f"round({c}, 6) as {c}" for c in W_MEASURES) + " from wp"


def weather_done(spark, sf, cubic_method="linear"):
    return pl.weather_pipeline(fx.weather(spark, sf), fx.INTERVAL_START, fx.INTERVAL_END, cubic_method=cubic_method)


def weather_bound(spark, sf):
    """Rows of the processed weather: sites x hours of the interval."""
    from wattlake.operators import timeseries as ts
    return ts.grid_rows(fx.weather(spark, sf), fx.INTERVAL_START, fx.INTERVAL_END)


@register("weather_pipeline", with_ctes(_WEATHER_SQL, *FILLED_CTES))
def q_weather_pipeline(spark, sf):
    return round_doubles(weather_done(spark, sf))


@register("weather_pipeline_cubic", with_recursive(_WEATHER_SQL, *CUBIC_FILLED_CTES))
def q_weather_pipeline_cubic(spark, sf):
    return round_doubles(weather_done(spark, sf, "cubic"))


_FEAT_SQL = """
select m.row_id, m.building_id, b.primary_use, b.square_feet, b.year_built, c.country,
  cast(dayofyear(m.timestamp) as int) as dayofyear, cast(hour(m.timestamp) as int) as hour,
  cast(isodow(m.timestamp) >= 6 as int) as is_weekend,
  cast(exists (select 1 from calendar k where k.country = c.country
               and k.holiday_date = cast(m.timestamp as date)) as int) as is_holiday,
  round(6.11 * pow(10.0, 7.5 * w.dew_temperature / (237.3 + w.dew_temperature)) * 100
        / (6.11 * pow(10.0, 7.5 * w.air_temperature / (237.3 + w.air_temperature))), 6) as rel_humidity,
  round(w.dew_temperature, 6) as dew_temperature, round(w.sea_level_pressure, 6) as sea_level_pressure,
  round(w.wind_speed, 6) as wind_speed, round(sin(radians(w.wind_direction)), 6) as wind_direction_y,
  b.site_id, m.meter
from meter_fx m left join building_fx b on m.building_id = b.building_id
left join wp w on b.site_id = w.site_id and m.timestamp = w.timestamp
left join countries_fx c on b.site_id = c.site_id"""


@register("feature_pipeline", with_ctes(_FEAT_SQL, METER_CTE, BUILDING_CTE, COUNTRIES_CTE, *FILLED_CTES,
                                        *_holiday_sql_ctes(_YEARS_FROM_METER)))
def q_feature_pipeline(spark, sf):
    return round_doubles(pl.feature_pipeline(fx.meter_readings(spark, sf), weather_done(spark, sf),
                                             fx.buildings(spark, sf), weather_rows=weather_bound(spark, sf)))


@register("eda_clean", with_ctes("""
select row_id, building_id, meter, timestamp, site_id, round(meter_reading, 6) as meter_reading,
  case meter when 0 then 'electricity' when 1 then 'chilledwater' when 2 then 'steam' when 3 then 'hotwater' end
    as meter_type,
  cast(dayofyear(timestamp) as int) as dayofyear, cast(month(timestamp) as int) as month,
  cast(day(timestamp) as int) as day, cast(isodow(timestamp) - 1 as int) as dayofweek,
  cast(hour(timestamp) as int) as hour
from conv where meter_reading <= (select q75 + (q75 - q25) * 50 from q)""", METER_CTE, BUILDING_CTE,
    """conv as (select m.row_id, m.building_id, m.meter, m.timestamp, b.site_id,
         case when b.site_id = 0 and m.meter = 0 then m.meter_reading * 0.2931
              when b.site_id = 0 and m.meter = 1 then m.meter_reading * 0.0833 else m.meter_reading end
           as meter_reading
  from meter_fx m left join building_fx b on m.building_id = b.building_id)""",
    """q as (select quantile_cont(meter_reading, 0.25) as q25, quantile_cont(meter_reading, 0.75) as q75
      from conv)"""))
def q_eda_clean(spark, sf):
    return round_doubles(pl.eda_clean(fx.meter_readings(spark, sf), fx.buildings(spark, sf)))


@register("building_clean", with_ctes("""
select building_id, site_id, primary_use, square_feet, cast(trunc(year_built) as int) as year_built, missing_year
from s3""", BUILDING_CTE,
    """s1 as (select building_id, site_id, primary_use, square_feet, cast(year_built is null as int) as missing_year,
       coalesce(year_built, median(year_built) over (partition by site_id)) as year_built from building_fx)""",
    """s2 as (select building_id, site_id, primary_use, square_feet, missing_year,
       coalesce(year_built, median(year_built) over (partition by primary_use)) as year_built from s1)""",
    """s3 as (select building_id, site_id, primary_use, square_feet, missing_year,
       coalesce(year_built, median(year_built) over (partition by site_id)) as year_built from s2)"""))
def q_building_clean(spark, sf):
    return pl.building_clean(fx.buildings(spark, sf))


# ------------------------------------------------------------------ models

_CACHE: dict = {}


def model_frame(spark, sf):
    """Training frame with an 80/10/10 hash split, written once per session."""
    key = ("frame", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        fr = pl.training_frame(fx.meter_readings(spark, sf), weather_done(spark, sf, "cubic"),
                               fx.buildings(spark, sf), weather_rows=weather_bound(spark, sf))
        fr = ml.assign_split(fr, ratios=(0.8, 0.1, 0.1))
        # the plan behind the rows (weather windows, holidays, joins) runs once
        _CACHE[key] = written_once(fr, "model-frame")
    return _CACHE[key]


def mean_area(spark, sf):
    """Training mean area per meter, kept with the models: scoring scales back by it."""
    return model_frame(spark, sf).groupBy("meter").agg(F.avg("square_feet").alias("__mean_square_feet"))


def encoding(spark, sf):
    """Encoders of the training rows, whatever models are fitted on them."""
    key = ("encoding", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        _CACHE[key] = pl.fit_encoding(model_frame(spark, sf).where(F.col("split") == "train"))
    return _CACHE[key]


def fitted(spark, sf, profile="a"):
    key = ("models", spark.sparkContext.applicationId, sf, profile)
    if key not in _CACHE:
        fr = model_frame(spark, sf)
        _CACHE[key] = pl.fit_models(fr.where(F.col("split") == "train"), profile,
                                    val=fr.where(F.col("split") == "val"), encoding=encoding(spark, sf))
    return _CACHE[key]


def _encoded(spark, sf):
    key = ("encoded", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        _CACHE[key] = written_once(encoding(spark, sf).transform(model_frame(spark, sf)), "model-encoded")
    return _CACHE[key]


@register("training_pipeline")
def q_training_pipeline(spark, sf):
    """units, outliers, features -> split -> encode -> GBT per meter -> RMSLE per meter of the training, validation and
    test rows (the test rows take no part in fitting or early stopping)."""
    fr = model_frame(spark, sf)
    encoding, models, _ = fitted(spark, sf, "a")
    pred = ml.predict_by_group(encoding.transform(fr), models)
    return ml.rmsle(pred, "meter_reading", "prediction", by=["meter", "split"], scale="log")


@register("boosted_fit_a")
def q_boosted_fit_a(spark, sf):
    fr = model_frame(spark, sf)
    encoding, models, _ = fitted(spark, sf, "a")
    pred = ml.predict_by_group(encoding.transform(fr.where(F.col("split") == "val")), models)
    return pred.select("row_id", "meter", "meter_reading", "prediction")


@register("boosted_fit_b")
def q_boosted_fit_b(spark, sf):
    fr = model_frame(spark, sf)
    encoding, models, _ = fitted(spark, sf, "b")
    pred = ml.predict_by_group(encoding.transform(fr.where(F.col("split") == "val")), models)
    return pred.select("row_id", "meter", "meter_reading", "prediction")


@register("predict_by_meter")
def q_predict_by_meter(spark, sf):
    fr = model_frame(spark, sf)
    encoding, models, _ = fitted(spark, sf, "a")
    return ml.predict_by_group(encoding.transform(fr), models).select("row_id", "meter", "prediction")


_FRAME_CTES = [METER_CTE, BUILDING_CTE, COUNTRIES_CTE, *CUBIC_FILLED_CTES, *_holiday_sql_ctes(_YEARS_FROM_METER), *lsql.FRAME]

#: All features; without the weather details; and without the building year too.
FEATURE_SETS = {
    "all": lsql.FEATURES,
    "no_weather_details": [f for f in lsql.FEATURES if f not in ("sea_level_pressure", "wind_direction_y", "rel_humidity")],
    "no_year": [f for f in lsql.FEATURES if f not in ("sea_level_pressure", "wind_direction_y", "rel_humidity", "year_built")],
}


def lasso_solved(spark, sf):
    """Lasso solutions per meter for 8 folds and none, 8 alphas and the feature sets, from one scan of the training rows."""
    key = ("lasso", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        train = ml.fold_column(model_frame(spark, sf).where(F.col("split") == "train"), folds=8)
        _CACHE[key] = linear.lasso_paths(train, pl.CAT_FEATURES, pl.NUM_FEATURES, "meter_reading", subsets=FEATURE_SETS)
    return _CACHE[key]


def linear_encoding(spark, sf):
    """Encoders of the complete training rows, as the linear models see them."""
    key = ("linear-encoding", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        train = model_frame(spark, sf).where(F.col("split") == "train").dropna(subset=[*pl.NUM_FEATURES, "meter_reading", "meter"])
        _CACHE[key] = stages.FeatureEncoder(catCols=pl.CAT_FEATURES, numCols=pl.NUM_FEATURES, by=["meter"],
                                            target="meter_reading").fit(train)
    return _CACHE[key]


def one_solution(solved, alpha, held=linear.NO_FOLD, name="all"):
    return solved.where((F.col("held") == held) & (F.col("feature_set") == name) & (F.abs(F.col("alpha") / alpha - 1) < 1e-9))


@register("transform_model_features", with_recursive(
    "select row_id, meter, " + ", ".join(f"round(z{i}, 6) as {c}" for i, c in enumerate(lsql.FEATURES)) + " from az",
    *_FRAME_CTES, *lsql.encoder_ctes(0), "all_rows as (select -1 as h, r.* from mf r)", *lsql.scaled_ctes("az", "all_rows")))
def q_transform_model_features(spark, sf):
    """All 14 model features of every row, encoded by stages fitted on the training rows in one read."""
    out = linear_encoding(spark, sf).transform(model_frame(spark, sf))
    return round_doubles(out.select("row_id", "meter", *lsql.FEATURES))


@register("lasso_fit_predict", with_recursive(
    f"""select r.row_id, r.meter, round(r.y, 4) as meter_reading, round(greatest({lsql.prediction()}, 0), 4) as prediction
from vz r left join sol s on s.meter = r.meter""",
    *_FRAME_CTES, *lsql.encoder_ctes(0), *lsql.lasso_ctes([1e-6], {"all": lsql.FEATURES}),
    "val_rows as (select -1 as h, r.* from mf r where part = 'val')", *lsql.scaled_ctes("vz", "val_rows")))
def q_lasso_fit_predict(spark, sf):
    """One Lasso (alpha 1e-6) per meter on the training rows; validation rows predicted, clipped at 0."""
    rows = linear_encoding(spark, sf).transform(model_frame(spark, sf).where(F.col("split") == "val"))
    pred = linear.predict(rows, one_solution(lasso_solved(spark, sf), 1e-6), lsql.FEATURES)
    return round_doubles(pred.select("row_id", "meter", "meter_reading", "prediction"), 4)


@register("grid_search_cv", with_recursive("""
select meter, feature_set, alpha, round(mean_msle, 4) as mean_msle, round(std_msle, 4) as std_msle,
  cast(row_number() over (partition by meter order by round(mean_msle, 6), alpha, feature_set) as int) as rank
from (select meter, fs as feature_set, alpha, avg(msle) as mean_msle, stddev_pop(msle) as std_msle from fs_scores group by all) g""",
    *_FRAME_CTES, *lsql.encoder_ctes(8), *lsql.lasso_ctes(linear.ALPHAS, FEATURE_SETS, "h >= 0"), *lsql.fold_scores()))
def q_grid_search_cv(spark, sf):
    """Lasso alpha in 1e-6 .. 10 and the feature sets, per meter: 8 folds of the training rows, encoders inside the fold."""
    got = linear.cross_validated(lasso_solved(spark, sf))
    return got.select("meter", "feature_set", "alpha", F.round("mean_msle", 4).alias("mean_msle"),
                      F.round("std_msle", 4).alias("std_msle"), "rank")


@register("cross_validate", with_recursive(
    "select meter, cast(h as int) as fold, round(msle, 4) as msle, round(sqrt(msle), 4) as rmsle from fs_scores",
    *_FRAME_CTES, *lsql.encoder_ctes(8), *lsql.lasso_ctes([1e-6], {"all": lsql.FEATURES}, "h >= 0"), *lsql.fold_scores()))
def q_cross_validate(spark, sf):
    """Score of every fold and meter, Lasso alpha 1e-6."""
    got = lasso_solved(spark, sf).where((F.col("held") >= 0) & (F.col("feature_set") == "all")
                                        & (F.abs(F.col("alpha") / 1e-6 - 1) < 1e-9))
    return got.select("meter", F.col("held").alias("fold"), F.round("msle", 4).alias("msle"),
                      F.round(F.sqrt("msle"), 4).alias("rmsle"))


@register("random_search")
def q_random_search(spark, sf):
    """50 settings of up to 5,000 rounds each, ended by 10 rounds without a better validation error."""
    enc = _encoded(spark, sf)
    return ml.random_search(enc.where(F.col("split") == "train"), enc.where(F.col("split") == "val"),
                            pl.MODEL_INPUTS, "meter_reading")


def _feature_list(spark, method, feats):
    return spark.createDataFrame([(method, f) for f in feats], "method string, feature string")


_SELECT_SQL = " union all ".join(
    [f"select meter, 'variance' as method, '{f}' as feature from te group by meter having var_samp(x{i}) >= 0.01" for i, f in enumerate(lsql.FEATURES)]
    + [f"select meter, 'target_corr', '{f}' from te group by meter having corr(x{i}, y) > 0.1" for i, f in enumerate(lsql.FEATURES)]
    + [f"select meter, 'uncorrelated', '{f}' from te group by meter having " + (" and ".join(
        f"coalesce(corr(x{k}, x{i}), 0) < 0.8" for k in range(i)) or "true") for i, f in enumerate(lsql.FEATURES)])


@register("select_filters_by_meter", with_recursive(_SELECT_SQL, *_FRAME_CTES, *lsql.encoder_ctes(0)))
def q_select_filters_by_meter(spark, sf):
    """Per meter, the features that the three filters keep: variance, correlation with the target, no earlier twin."""
    train = model_frame(spark, sf).where(F.col("split") == "train")
    return linear.selections(train, pl.CAT_FEATURES, pl.NUM_FEATURES, "meter_reading",
                             methods=("variance", "target_corr", "uncorrelated"))


@register("selection_table")
def q_selection_table(spark, sf):
    """All methods side by side per meter, with votes: the filters, Lasso and recursive elimination from the sums of one
    scan, and tree importance."""
    train = model_frame(spark, sf).where(F.col("split") == "train")
    chosen = linear.selections(train, pl.CAT_FEATURES, pl.NUM_FEATURES, "meter_reading")
    rows = linear_encoding(spark, sf).transform(train.dropna(subset=[*pl.NUM_FEATURES, "meter_reading", "meter"])).cache()
    meters = [r[0] for r in rows.select("meter").distinct().orderBy("meter").collect()]  # meter types
    tree = [(m, "tree", f) for m in meters
            for f in ml.select_by_importance(rows.where(F.col("meter") == m), lsql.FEATURES, "meter_reading")]
    rows.unpersist()
    both = chosen.unionByName(spark.createDataFrame(tree, "meter int, method string, feature string"))
    return linear.side_by_side(both, lsql.FEATURES, (*linear.METHODS, "tree"))


@register("select_by_l1")
def q_select_by_l1(spark, sf):
    enc = _encoded(spark, sf).where(F.col("split") == "train")
    return _feature_list(spark, "lasso", ml.select_by_l1(enc, pl.MODEL_INPUTS, "meter_reading", alpha=1e-3))


@register("select_by_importance")
def q_select_by_importance(spark, sf):
    enc = _encoded(spark, sf).where(F.col("split") == "train")
    return _feature_list(spark, "tree", ml.select_by_importance(enc, pl.MODEL_INPUTS, "meter_reading"))


@register("recursive_elimination")
def q_recursive_elimination(spark, sf):
    enc = _encoded(spark, sf).where(F.col("split") == "train")
    return _feature_list(spark, "rfe_l1", ml.recursive_elimination(enc, pl.MODEL_INPUTS, "meter_reading"))


@register("pca")
def q_pca(spark, sf):
    enc = _encoded(spark, sf)
    m = ml.pca(enc, pl.MODEL_INPUTS, 2)
    ev = m.stages[-1].explainedVariance.toArray().tolist()
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(ev)], "component int, explained_variance double")


@register("pca_loadings", with_recursive(
    lsql.loadings(), *_FRAME_CTES, *lsql.encoder_ctes(0), *lsql.lasso_ctes([1e-6], {"all": lsql.FEATURES})[:2], *lsql.component_ctes()))
def q_pca_loadings(spark, sf):
    """The first two components of each meter's encoded training features: shares of variance and loadings."""
    train = model_frame(spark, sf).where(F.col("split") == "train")
    out = linear.principal_components(train, pl.CAT_FEATURES, pl.NUM_FEATURES, "meter_reading")
    return round_doubles(out, 4)


@register("pca_by_variance")
def q_pca_by_variance(spark, sf):
    enc = _encoded(spark, sf)
    k90, ev = ml.pca_by_variance(enc, pl.MODEL_INPUTS, 0.90)
    k95, _ = ml.pca_by_variance(enc, pl.MODEL_INPUTS, 0.95)
    return spark.createDataFrame([(0.90, k90), (0.95, k95)], "share double, n_components int")


def bundle(spark, sf, profile="a") -> ModelBundle:
    """Encoders, models and training mean area, as scoring takes them."""
    encoding, models, _ = fitted(spark, sf, profile)
    return ModelBundle(encoding, models, mean_area(spark, sf), pl.MODEL_INPUTS)


@register("prediction_pipeline")
def q_prediction_pipeline(spark, sf):
    """Scoring rows (no target) -> features -> encode -> predict -> inverse -> units."""
    feats = pl.feature_pipeline(fx.scoring_meter(spark, sf), weather_done(spark, sf, "cubic"),
                                pl.building_clean(fx.buildings(spark, sf)), feats=pl.MODEL_FEATURES,
                                keep=("row_id",), weather_rows=weather_bound(spark, sf))
    return pl.prediction_pipeline(feats, bundle(spark, sf))


@register("score")
def q_score(spark, sf):
    """Flagship batch job: saved models -> validate -> weather over the input's interval ->
    merge -> features -> null report -> predict -> (row_id, meter_reading)."""
    building = fx.buildings(spark, sf)
    return pl.score(fx.scoring_meter(spark, sf), fx.weather(spark, sf), building, saved_models(spark, sf),
                    on_nulls="report", meter_limits=pl.building_limits(building))


def saved_models(spark, sf) -> str:
    """Path of the fitted bundle, saved once per session."""
    key = ("saved", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        path = scratch_dir(spark, "models")
        bundle(spark, sf).save(spark, path)
        _CACHE[key] = path
    return _CACHE[key]


@register("score_null_report", with_ctes("""
select 'rows' as item, count(*) as n from meter_fx
union all select 'building_id', count(*) filter (where building_id is null) from meter_fx
union all select 'primary_use', count(*) filter (where b.primary_use is null)
  from meter_fx m left join building_fx b on m.building_id = b.building_id
union all select 'square_feet', count(*) filter (where b.square_feet is null)
  from meter_fx m left join building_fx b on m.building_id = b.building_id
union all select 'meter', count(*) filter (where meter is null) from meter_fx""", METER_CTE, BUILDING_CTE))
def q_score_null_report(spark, sf):
    """The null report of the scoring job, taken while it writes its encoded rows: rows, and nulls of the columns that
    come from the meter and building tables."""
    building = fx.buildings(spark, sf)
    got = pl.score_report(fx.scoring_meter(spark, sf), fx.weather(spark, sf), building, saved_models(spark, sf),
                          on_nulls="report", meter_limits=pl.building_limits(building))
    items = [("rows", got.rows)] + [(c, got.nulls[c]) for c in ("building_id", "primary_use", "square_feet", "meter")]
    return spark.createDataFrame(items, "item string, n long")


@register("merge_data", with_ctes("""
select m.row_id, m.building_id, m.meter, m.timestamp, m.meter_reading, b.site_id, b.primary_use,
       b.square_feet, b.year_built, b.floor_count, """
    + ", ".join(f"round(w.{c}, 6) as {c}" for c in W_MEASURES) + """
from meter_fx m left join building_fx b on m.building_id = b.building_id
left join wp w on b.site_id = w.site_id and m.timestamp = w.timestamp""", METER_CTE, BUILDING_CTE, *FILLED_CTES))
def q_merge_data(spark, sf):
    """meter ⟕ building ⟕ processed weather (the modelled merge step)."""
    from wattlake.operators.joins import merge_data
    return round_doubles(merge_data(fx.meter_readings(spark, sf), weather_done(spark, sf), fx.buildings(spark, sf),
                                    weather_rows=weather_bound(spark, sf)))
