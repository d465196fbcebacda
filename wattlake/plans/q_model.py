"""Registered queries: encoders (2.8), splits / metrics / selection (2.9),
validation (2.10), set operations (2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import encoders as enc
from wattlake.operators import ml
from wattlake.operators import profiling as pr
from wattlake.operators import setops
from wattlake.operators import stages
from wattlake.operators import validation as val
from wattlake.operators.joins import join_building, join_models, attach_keys, align_by_position
from wattlake.plans.common import round_doubles
from wattlake.plans.registry import (BUILDING_CTE, MB_CTE, METER_CTE, PRED_CTE, WEATHER_CTE, register,
                                     with_ctes)
from wattlake.session import scratch_dir
from wattlake.sources import fixtures as fx
from wattlake.sources.state import load_state, save_state

RARE_CTE = """counts as (select meter, primary_use as category, count(*) as n from mb
                         where primary_use is not null group by 1, 2),
kept as (select c.meter, 'primary_use' as variable, c.category from counts c
         join (select meter, sum(n) as total, count(*) as n_cats from counts group by 1) t on c.meter = t.meter
         where t.n_cats <= 10 or c.n / t.total >= 0.05),
rare as (select m.row_id, m.meter, m.meter_reading, m.square_feet,
                case when k.category is not null then m.primary_use else 'Rare' end as primary_use
         from mb m left join kept k on m.meter = k.meter and m.primary_use = k.category)"""


def mb(spark, sf):
    return join_building(fx.meter_readings(spark, sf), fx.buildings(spark, sf)).drop("floor_count")


# ----------------------------------------------------------------- encoders

@register("rare_label_encode", with_ctes("select row_id, meter, primary_use from rare",
                                         METER_CTE, BUILDING_CTE, MB_CTE, RARE_CTE))
def q_rare_label_encode(spark, sf):
    d = mb(spark, sf)
    model = enc.RareLabelEncoder(["primary_use"], by=("meter",)).fit(d)
    return model.transform(d).select("row_id", "meter", "primary_use")


@register("state_save_load", with_ctes("select meter, variable, category from kept",
                                       METER_CTE, BUILDING_CTE, MB_CTE, RARE_CTE))
def q_state_save_load(spark, sf):
    model = enc.RareLabelEncoder(["primary_use"], by=("meter",)).fit(mb(spark, sf))
    path = save_state({"rare": model.state}, scratch_dir(spark, "encoder-state"))
    return load_state(spark, path, ["rare"])["rare"]


@register("mean_target_encode", with_ctes("""
select m.row_id, m.meter, round(e.mean, 6) as primary_use
from mb m left join (select meter, primary_use, avg(meter_reading) as mean from mb group by 1, 2) e
  on m.meter = e.meter and m.primary_use = e.primary_use""", METER_CTE, BUILDING_CTE, MB_CTE))
def q_mean_target_encode(spark, sf):
    d = mb(spark, sf)
    model = enc.MeanTargetEncoder(["primary_use"], "meter_reading", by=("meter",)).fit(d)
    return round_doubles(model.transform(d).select("row_id", "meter", "primary_use"))


@register("standard_scale", with_ctes("""
select m.row_id, m.meter,
  round((m.square_feet - s.m1) / case when s.s1 = 0 then 1 else s.s1 end, 6) as square_feet,
  round((m.year_built - s.m2) / case when s.s2 = 0 then 1 else s.s2 end, 6) as year_built
from mb m left join (select meter, avg(square_feet) as m1, stddev_pop(square_feet) as s1,
                            avg(year_built) as m2, stddev_pop(year_built) as s2 from mb group by 1) s
  on m.meter = s.meter""", METER_CTE, BUILDING_CTE, MB_CTE))
def q_standard_scale(spark, sf):
    d = mb(spark, sf).select("row_id", "meter", "square_feet", "year_built")
    model = enc.StandardScaler(["square_feet", "year_built"], by=("meter",)).fit(d)
    return round_doubles(model.transform(d))


@register("one_hot_encode", with_ctes("""
select b.building_id, cast(c.country = 'CA' as int) as country_CA, cast(c.country = 'IE' as int) as country_IE,
       cast(c.country = 'UK' as int) as country_UK, cast(c.country = 'US' as int) as country_US
from building_fx b left join (select * from (values (0, 'US'), (1, 'UK'), (2, 'US'), (3, 'US'), (4, 'US'),
  (5, 'UK'), (6, 'US'), (7, 'CA'), (8, 'US'), (9, 'US'), (10, 'US'), (11, 'CA'), (12, 'IE'), (13, 'US'),
  (14, 'US'), (15, 'US')) t(site_id, country)) c on b.site_id = c.site_id""", BUILDING_CTE))
def q_one_hot_encode(spark, sf):
    from wattlake.functions import country_of_site
    b = fx.buildings(spark, sf).select("building_id", country_of_site(F.col("site_id")).alias("country"))
    return enc.one_hot(b, "country")


@register("one_hot_sparse", with_ctes("""
select building_id, cast(k as int) as slots, cast(rank as int) as slot
from (select building_id, primary_use, dense_rank() over (order by primary_use) - 1 as rank,
             (select count(distinct primary_use) from building_fx) as k from building_fx) t""", BUILDING_CTE))
def q_one_hot_sparse(spark, sf):
    """The primary use as sparse vectors by a stored dictionary; each vector's size and hot slot."""
    from pyspark.ml.functions import vector_to_array
    b = fx.buildings(spark, sf).select("building_id", "primary_use")
    out = stages.DictionaryEstimator(inputCol="primary_use").fit(b).transform(b)
    hot = vector_to_array("one_hot")
    return out.select("building_id", F.size(hot).alias("slots"), (F.array_position(hot, 1.0) - 1).cast("int").alias("slot"))


@register("transform_features", with_ctes("""
select r.row_id, r.meter,
  round((e.mean - s.m1) / case when s.s1 = 0 then 1 else s.s1 end, 6) as primary_use,
  round((r.square_feet - s.m2) / case when s.s2 = 0 then 1 else s.s2 end, 6) as square_feet
from rare r
left join (select meter, primary_use, avg(meter_reading) as mean from rare group by 1, 2) e
  on r.meter = e.meter and r.primary_use = e.primary_use
left join (select r2.meter, avg(e2.mean) as m1, stddev_pop(e2.mean) as s1,
                  avg(r2.square_feet) as m2, stddev_pop(r2.square_feet) as s2
           from rare r2 left join (select meter, primary_use, avg(meter_reading) as mean from rare group by 1, 2) e2
             on r2.meter = e2.meter and r2.primary_use = e2.primary_use group by 1) s on r.meter = s.meter""",
    METER_CTE, BUILDING_CTE, MB_CTE, RARE_CTE))
def q_transform_features(spark, sf):
    d = mb(spark, sf).select("row_id", "meter", "meter_reading", "primary_use", "square_feet")
    e = enc.fit_encoding(d, ["primary_use"], ["square_feet"], "meter_reading", by=("meter",))
    return round_doubles(e.transform(d).select("row_id", "meter", "primary_use", "square_feet"))


# -------------------------------------------------------------- splits etc.

SPLIT_SQL = "cast('0x' || substr(md5(cast(row_id as varchar)), 1, 8) as bigint) % 100"


@register("train_val_test_split", with_ctes(f"""
select row_id, case when {SPLIT_SQL} < 64 then 'train' when {SPLIT_SQL} < 80 then 'val' else 'test' end as split
from meter_fx""", METER_CTE))
def q_train_val_test_split(spark, sf):
    return ml.assign_split(fx.meter_readings(spark, sf).select("row_id"), ratios=(0.64, 0.16, 0.20))


@register("separate_target", with_ctes("select row_id, building_id, meter, timestamp from meter_fx", METER_CTE))
def q_separate_target(spark, sf):
    x, _ = ml.split_xy(fx.meter_readings(spark, sf), "meter_reading")
    return x


@register("rmsle", with_ctes("""
select meter, round(avg(pow(ln(1 + meter_reading) - ln(1 + pred_a), 2)), 6) as msle,
       round(sqrt(avg(pow(ln(1 + meter_reading) - ln(1 + pred_a), 2))), 6) as rmsle, count(*) as n
from pred group by meter""", METER_CTE, PRED_CTE))
def q_rmsle(spark, sf):
    return round_doubles(ml.rmsle(fx.predictions(spark, sf), "meter_reading", "pred_a", by=["meter"]))


@register("r2_score", with_ctes("""
select p.meter, round(1 - sum(pow(meter_reading - pred_b, 2)) / sum(pow(meter_reading - ym, 2)), 6) as r2
from pred p join (select meter, avg(meter_reading) as ym from pred group by 1) m on p.meter = m.meter
group by p.meter""", METER_CTE, PRED_CTE))
def q_r2_score(spark, sf):
    return round_doubles(ml.r2(fx.predictions(spark, sf), "meter_reading", "pred_b", by=["meter"]))


_SEL_FEATS = ["air_temperature", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed",
              "square_feet", "year_built"]


def _sel_frame(spark, sf):
    from wattlake.operators.joins import merge_data
    return merge_data(fx.meter_readings(spark, sf), fx.weather(spark, sf), fx.buildings(spark, sf))


def _sel_sql():
    corr_pairs = []
    for i, a in enumerate(_SEL_FEATS):
        for b in _SEL_FEATS[i + 1:]:
            corr_pairs.append(f"select '{a}' as col1, '{b}' as col2, corr({a}, {b}) as c from f")
    var = "\nunion all\n".join(f"select 'variance' as method, '{c}' as feature from f having var_samp({c}) >= 0.01"
                               for c in _SEL_FEATS)
    tc = "\nunion all\n".join(f"select 'target_corr', '{c}' from f having corr({c}, meter_reading) > 0.1"
                              for c in _SEL_FEATS)
    unc = ("select 'uncorrelated', feature from (values " + ", ".join(f"('{c}')" for c in _SEL_FEATS)
           + ") a(feature) where feature not in (select col2 from (" + "\nunion all\n".join(corr_pairs)
           + ") p where c >= 0.8)")
    return with_ctes(f"""
select a.feature, coalesce(v.votes, 0) as votes
from (values {", ".join(f"('{c}')" for c in _SEL_FEATS)}) a(feature)
left join (select feature, count(distinct method) as votes from ({var}
  union all {tc}
  union all {unc}) s group by 1) v on a.feature = v.feature""", METER_CTE, BUILDING_CTE, WEATHER_CTE,
        """f as (select m.meter_reading, b.square_feet, b.year_built, w.air_temperature, w.dew_temperature,
                   w.sea_level_pressure, w.wind_direction, w.wind_speed
            from meter_fx m left join building_fx b on m.building_id = b.building_id
            left join weather_fx w on b.site_id = w.site_id and m.timestamp = w.timestamp)""")


@register("selection_votes", _sel_sql())
def q_selection_votes(spark, sf):
    """Votes of three data-driven filters: variance >= 0.01, correlation
    with the target > 0.1, and not the second column of a pair with
    correlation >= 0.8."""
    d = _sel_frame(spark, sf).select("meter_reading", *_SEL_FEATS)
    feats = spark.createDataFrame([(c,) for c in _SEL_FEATS], "feature string")
    return ml.selection_votes(pr.filter_selections(d, _SEL_FEATS, "meter_reading"), feats)


# -------------------------------------------------------------- validation

@register("validate_columns", with_ctes("""
select * from (values ('meter', 'building_id', true, true), ('meter', 'meter', true, true),
  ('meter', 'timestamp', true, true), ('weather', 'site_id', true, true), ('weather', 'timestamp', true, true),
  ('weather', 'air_temperature', true, true), ('weather', 'dew_temperature', true, true),
  ('weather', 'sea_level_pressure', true, true), ('weather', 'wind_speed', true, true),
  ('weather', 'wind_direction', true, true)) t("table", "column", present, supported)""", METER_CTE))
def q_validate_columns(spark, sf):
    from wattlake.constants import METER_COLS, WEATHER_COLS
    return val.validate_columns(fx.meter_readings(spark, sf), METER_COLS, "meter").unionByName(
        val.validate_columns(fx.weather(spark, sf), WEATHER_COLS, "weather"))


_MV = """select 'meter' as "table", 'building_id >= 0' as rule, count(*) filter (where building_id < 0) as violations from meter_fx
union all select 'meter', 'building_id <= 1448', count(*) filter (where building_id > 1448) from meter_fx
union all select 'meter', 'meter >= 0', count(*) filter (where meter < 0) from meter_fx
union all select 'meter', 'meter <= 3', count(*) filter (where meter > 3) from meter_fx"""
_WV = "\nunion all\n".join(
    f"select 'weather', '{c} {op} {v}', count(*) filter (where {c} {neg} {v}) from weather_fx"
    for c, lo, hi in [("site_id", 0, 15), ("air_temperature", -95, 95), ("dew_temperature", -95, 95),
                      ("sea_level_pressure", 800, 1100), ("wind_speed", 0, None), ("wind_direction", 0, 360)]
    for op, neg, v in ([(">=", "<", lo)] if lo is not None else []) + ([("<=", ">", hi)] if hi is not None else []))


@register("validate_meter", with_ctes(_MV, METER_CTE))
def q_validate_meter(spark, sf):
    return val.validate_meter(fx.meter_readings(spark, sf))


@register("validate_weather", with_ctes(_WV.replace("select 'weather', ", "select 'weather' as \"table\", ", 1)
                                        .replace("', count(*)", "' as rule, count(*)", 1)
                                        .replace(" from weather_fx", " as violations from weather_fx", 1),
                                        WEATHER_CTE))
def q_validate_weather(spark, sf):
    return val.validate_weather(fx.weather(spark, sf))


@register("validate_inputs", with_ctes(
    "select * from (values ('meter', 'column building_id', 0), ('meter', 'column meter', 0), "
    "('meter', 'column timestamp', 0), ('weather', 'column site_id', 0), ('weather', 'column timestamp', 0), "
    "('weather', 'column air_temperature', 0), ('weather', 'column dew_temperature', 0), "
    "('weather', 'column sea_level_pressure', 0), ('weather', 'column wind_speed', 0), "
    "('weather', 'column wind_direction', 0)) t(\"table\", rule, violations)\nunion all\n" + _MV + "\nunion all\n"
    + _WV, METER_CTE, WEATHER_CTE))
def q_validate_inputs(spark, sf):
    return val.validate_inputs(fx.meter_readings(spark, sf), fx.weather(spark, sf))


# ----------------------------------------------------------- set operations

@register("sort_rows", with_ctes("select * from meter_fx order by building_id, meter, timestamp, row_id",
                                 METER_CTE))
def q_sort_rows(spark, sf):
    return setops.sort_rows(fx.meter_readings(spark, sf), ["building_id", "meter", "timestamp", "row_id"])


@register("top_n", with_ctes("""
select building_id, round(sum(meter_reading), 6) as total_reading from meter_fx group by 1
order by total_reading desc, building_id limit 10""", METER_CTE))
def q_top_n(spark, sf):
    t = fx.meter_readings(spark, sf).groupBy("building_id").agg(F.sum("meter_reading").alias("total_reading"))
    return round_doubles(setops.top_n(t, 10, [F.desc("total_reading"), F.col("building_id")]))


@register("union_all", with_ctes("select * from meter_fx", METER_CTE))
def q_union_all(spark, sf):
    m = fx.meter_readings(spark, sf)
    parts = setops.split_by(m, "meter", [0, 1, 2, 3])
    return setops.union_all([p.withColumn("meter", F.lit(k)) for k, p in parts.items()]).select(*m.columns)


@register("split_by_value", with_ctes("select meter, count(*) as rows, 4 as cols from meter_fx group by 1",
                                      METER_CTE))
def q_split_by_value(spark, sf):
    return setops.split_shapes(fx.meter_readings(spark, sf), "meter")


@register("split_counts_check", with_ctes("""
select meter, count(*) as n_input, count(*) as n_output, true as equal from meter_fx group by 1""", METER_CTE))
def q_split_counts_check(spark, sf):
    p = fx.predictions(spark, sf)
    scored = setops.union_all(list(setops.split_by(p, "meter", [0, 1, 2, 3]).values()))
    # parts dropped the key; re-attach it by row id to compare per meter
    scored = attach_keys(scored.select("row_id", "pred_a"), p.select("row_id", "meter"))
    return setops.compare_counts(fx.meter_readings(spark, sf), scored, "meter", "n_input", "n_output")


@register("join_predictions", with_ctes("""
select m.row_id, m.building_id, m.meter, round(p.pred_a, 6) as pred_a
from meter_fx m left join pred p on m.row_id = p.row_id""", METER_CTE, PRED_CTE))
def q_join_predictions(spark, sf):
    keys = fx.meter_readings(spark, sf).select("row_id", "building_id", "meter")
    return round_doubles(attach_keys(fx.predictions(spark, sf).select("row_id", "pred_a"), keys))


@register("join_model_outputs", with_ctes("""
select row_id, round(pred_a, 6) as model_a, round(pred_b, 6) as model_b from pred""", METER_CTE, PRED_CTE))
def q_join_model_outputs(spark, sf):
    p = fx.predictions(spark, sf)
    return round_doubles(join_models({"model_a": p.select("row_id", F.col("pred_a").alias("meter_reading")),
                                      "model_b": p.select("row_id", F.col("pred_b").alias("meter_reading"))}))


@register("align_by_position", with_ctes("""
select cast(coalesce(a.pos, b.pos, c.pos, d.pos) as int) as pos, coalesce(cast(a.b as varchar), '') as meter_0,
       coalesce(cast(b.b as varchar), '') as meter_1, coalesce(cast(c.b as varchar), '') as meter_2,
       coalesce(cast(d.b as varchar), '') as meter_3
from l0 a full join l1 b on a.pos = b.pos full join l2 c on coalesce(a.pos, b.pos) = c.pos
full join l3 d on coalesce(a.pos, b.pos, c.pos) = d.pos""", METER_CTE,
    *[f"""l{k} as (select building_id as b, row_number() over (order by building_id) - 1 as pos
      from (select distinct building_id from meter_fx where meter = {k}) t)""" for k in range(4)]))
def q_align_by_position(spark, sf):
    lists = fx.meter_readings(spark, sf).select("meter", "building_id").distinct()
    return align_by_position(lists, "meter", "building_id", groups=[0, 1, 2, 3])
