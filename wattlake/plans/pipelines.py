"""Composite pipelines (inventory 2.11): chained DataFrame transforms, one
lazy plan per stage; the only materialised points are fitted state and the
cached model frame during training."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.constants import (CUBIC_FILL_COLS, LINEAR_FILL_COLS, METER_COLS, METER_LIMITS, METER_NAMES,
                                MODEL_FEATURES, WEATHER_COLS, WEATHER_LIMITS)
from wattlake.functions import convert_units, date_parts, map_lookup, restore_site0_units
from wattlake.operators import features as feat
from wattlake.operators import filters as flt
from wattlake.operators import holidays as hol
from wattlake.operators import impute
from wattlake.operators import ml
from wattlake.operators import profiling as pr
from wattlake.operators import stages
from wattlake.operators import timeseries as ts
from wattlake.operators import validation as val
from wattlake.operators.bundle import ModelBundle
from wattlake.operators.bundle import load as load_bundle
from wattlake.operators.joins import join_building, merge_data
from wattlake.session import written_once

CAT_FEATURES = ["primary_use", "country"]
NUM_FEATURES = [c for c in MODEL_FEATURES if c not in CAT_FEATURES + ["site_id", "meter"]]
MODEL_INPUTS = [c for c in MODEL_FEATURES if c not in ("site_id", "meter")]


def weather_pipeline(weather: DataFrame, start, end, cubic_method: str = "cubic",
                     copy_col: str = "sea_level_pressure", copy_from: int = 1, copy_to: int = 5,
                     offsets=None) -> DataFrame:
    """local time -> reindex to [start, end] -> fill (linear / cubic, then
    ffill+bfill) -> copy one site's column to a site that lacks it."""
    w = ts.to_local_time(weather, offsets)
    w = ts.reindex_time(w, start, end)
    w = ts.fill_missing(w, linear_cols=LINEAR_FILL_COLS, cubic_cols=CUBIC_FILL_COLS, cubic_method=cubic_method)
    return ts.copy_site_column(w, copy_col, copy_from, copy_to)


def building_clean(building: DataFrame) -> DataFrame:
    """drop floor_count, flag missing year (before imputing), cascade impute."""
    b = building.drop("floor_count")
    b = impute.missing_flag(b, "year_built", "missing_year")
    return impute.impute_year_built(b)


def feature_pipeline(meter: DataFrame, weather: DataFrame, building: DataFrame,
                     feats: Sequence[str] | None = tuple(MODEL_FEATURES),
                     keep: Sequence[str] = ("row_id",), weather_rows: int | None = None,
                     calendar: DataFrame | None = None) -> DataFrame:
    """merge -> humidity / wind -> date parts -> country / holiday -> select.
    ``keep`` columns (row id, target) ride along in front of the features.
    ``weather_rows``: proven bound of the weather rows (see ``join_weather``).
    ``calendar``: holidays of all years of ``meter``; without it one aggregate finds the years."""
    mbw = merge_data(meter, weather, building, weather_rows=weather_rows)
    cal = hol.calendar_for(meter) if calendar is None else calendar
    out = feat.feature_frame(mbw, cal, None)
    if feats is None:
        return out
    cols = [c for c in keep if c in out.columns] + [c for c in feats if c not in keep]
    return out.select(*cols)


def site0_units(reading, site, meter):
    """Site 0 reports kBTU: electricity to kWh, chilled water to tons (undone by ``restore_site0_units``)."""
    reading = convert_units(reading, site, meter, 0, 0, "kbtu_to_kwh")
    return convert_units(reading, site, meter, 0, 1, "kbtu_to_ton")


def eda_clean(meter: DataFrame, building: DataFrame, mult: float = 50) -> DataFrame:
    """site-0 electricity kBTU -> kWh and chilled water kBTU -> tons, IQR outlier removal (upper only,
    global), meter name, date parts."""
    mb = join_building(meter, building.select("building_id", "site_id"))
    mb = mb.withColumn("meter_reading", site0_units(F.col("meter_reading"), F.col("site_id"), F.col("meter")))
    upper = pr.outlier_thresholds(mb, "meter_reading", "iqr", mult).select("upper").scalar()
    mb = flt.remove_outliers(mb, "meter_reading", upper)
    mb = mb.withColumn("meter_type", map_lookup(F.col("meter"), METER_NAMES))
    return date_parts(mb)


def training_frame(meter: DataFrame, weather_done: DataFrame, building: DataFrame,
                   per: str | None = "meter", weather_rows: int | None = None, outliers: float | None = 50) -> DataFrame:
    """Model frame: positive readings in training units (site 0 converted), without readings above
    q75 + ``outliers`` x IQR of all converted readings; features; target = log1p(reading normalised by area)."""
    units = join_building(meter, building.select("building_id", "site_id"))
    units = units.withColumn("meter_reading", site0_units(F.col("meter_reading"), F.col("site_id"), F.col("meter")))
    m = flt.drop_nonpositive(units).where(F.col("meter_reading").isNotNull())
    if outliers is not None:
        upper = pr.outlier_thresholds(units, "meter_reading", "iqr", outliers).select("upper").scalar()
        m = flt.remove_outliers(m, "meter_reading", upper)
    fr = feature_pipeline(m.drop("site_id"), weather_done, building_clean(building),
                          feats=MODEL_FEATURES, keep=("row_id", "meter_reading"), weather_rows=weather_rows)
    fr = feat.normalize_by_area(fr, per=per)
    return fr.withColumn("meter_reading", F.log1p("meter_reading"))


def fit_encoding(train: DataFrame, by: str = "meter") -> PipelineModel:
    """Encoders fitted on ``train`` per meter type (one read)."""
    return stages.FeatureEncoder(catCols=CAT_FEATURES, numCols=NUM_FEATURES, by=[by], target="meter_reading").fit(train)


def fit_models(train: DataFrame, profile: str = "a", by: str = "meter", val: DataFrame | None = None,
               encoding: PipelineModel | None = None):
    """Encoders fitted on ``train`` (unless given), then one boosted model
    per meter, on the encoded rows written once in a directory per meter.  With ``val``, its rows ride along flagged in ``is_val`` and
    the booster stops once its patience with them is over."""
    encoding = encoding or fit_encoding(train, by)
    rows = train.withColumn("is_val", F.lit(False))
    if val is not None:
        rows = rows.unionByName(val.withColumn("is_val", F.lit(True)))
    encoded = written_once(encoding.transform(rows), "training", [by])
    vcol = "is_val" if val is not None else None
    models = ml.fit_by_group(encoded, lambda: ml.gbt(MODEL_INPUTS, "meter_reading", profile, vcol), by=by)
    return encoding, models, encoded


def encoded_frame(features: DataFrame, encoders, nulls: pr.NullReport | None = None) -> DataFrame:
    """Feature rows (watched by ``nulls``), encoded; the unscaled area rides along in ``__area``."""
    rows = nulls.watch(features) if nulls else features
    return encoders.transform(rows.withColumn("__area", F.col("square_feet")))


def written_by_meter(encoded: DataFrame) -> DataFrame:
    """The encoded rows, written once to the shared folder in one directory per meter, as a scan of it: what filters
    on the meter reads that meter's files only, and the plan behind the rows runs once however many models there are."""
    return written_once(encoded, "encoded", ["meter"])


def predict_rows(rows: DataFrame, bundle: ModelBundle) -> DataFrame:
    """per-meter predict (clip 0) -> expm1 x area / mean area -> site-0 units -> (row_id, meter_reading).  Keys ride
    along through the model transform (no join back by row id)."""
    pred = ml.predict_by_group(rows, bundle.models, "meter", "prediction")
    pred = pred.select("row_id", "site_id", "meter", F.col("__area").alias("square_feet"),
                       F.col("prediction").alias("meter_reading"))
    pred = feat.inverse_target(pred, "meter_reading", "square_feet", per="meter", mean_area=bundle.mean_area)
    pred = pred.withColumn("meter_reading", restore_site0_units(F.col("meter_reading"), F.col("site_id"),
                                                                F.col("meter")))
    return pred.select("row_id", "meter_reading")


def prediction_pipeline(features: DataFrame, bundle: ModelBundle) -> DataFrame:
    """encode -> write once, by meter -> predict each meter's files with its model (see ``predict_rows``)."""
    return predict_rows(written_by_meter(encoded_frame(features, bundle.encoders)), bundle)


def building_limits(building: DataFrame) -> dict:
    """Meter validation limits from the building dimension: ids must be
    0..max(building_id) (the fixed 0..1448 is that bound for the modelled
    1,449-building table)."""
    hi = building.agg(F.max("building_id")).first()[0]
    return {"building_id": (0, int(hi) if hi is not None else 0), "meter": (0, 3)}


class Scored(NamedTuple):
    predictions: DataFrame        # (row_id, meter_reading)
    rows: int                     # feature rows seen
    nulls: dict[str, int]         # nulls per feature column


def score(meter: DataFrame, weather: DataFrame, building: DataFrame, model: ModelBundle | str,
          on_nulls: str = "raise", bounds: str = "reference", meter_limits: dict | None = None) -> DataFrame:
    """Predictions of ``score_report``."""
    return score_report(meter, weather, building, model, on_nulls, bounds, meter_limits).predictions


def score_report(meter: DataFrame, weather: DataFrame, building: DataFrame, model: ModelBundle | str,
                 on_nulls: str = "raise", bounds: str = "reference", meter_limits: dict | None = None) -> Scored:
    """Batch scoring job: validate -> weather pipeline over the input's own interval -> merge -> features -> null
    report -> predict.  ``model`` is a bundle or the path of a saved one.

    The meter table is read once.  While its encoded rows are written, observation metrics count the violations of the
    meter rules, the nulls of every feature and the years of the rows; nothing is predicted if a rule is violated, or,
    with ``on_nulls='raise'``, if a feature has nulls (``'report'`` predicts and returns the counts).

    ``bounds='reference'`` takes start/end before the local-time shift (the
    modelled behaviour); ``'local'`` takes them after."""
    if on_nulls not in ("raise", "report"):
        raise ValueError("on_nulls: raise or report")
    spark = meter.sparkSession
    bundle = load_bundle(spark, model) if isinstance(model, str) else model
    val.check_columns(meter, METER_COLS, "meter")
    val.check_columns(weather, WEATHER_COLS, "weather")
    val.check_ranges(weather, WEATHER_LIMITS, "weather")
    local = ts.to_local_time(weather)
    b = (local if bounds == "local" else weather).agg(F.min("timestamp").alias("s"), F.max("timestamp").alias("e")).first()
    if b["s"] is None:
        raise ValueError("the weather table has no rows")
    w = weather_pipeline(weather, b["s"], b["e"])
    sites = ts.grid_rows(local, b["s"], b["e"])
    clean = building_clean(building)
    rules = val.range_rules(meter_limits or METER_LIMITS)
    years = (b["s"].year, b["e"].year)
    while True:
        # watched where the rows enter: rules and years; and where the features are complete: nulls
        entry = pr.NullReport({f"r{i}": e for i, (_, e) in enumerate(rules)}
                              | {"first": F.min(F.year("timestamp")), "last": F.max(F.year("timestamp"))})
        nulls = pr.NullReport()
        cal = hol.holiday_calendar(spark, range(years[0] - 1, years[1] + 2))
        fr = feature_pipeline(entry.watch(meter), w, clean, feats=MODEL_FEATURES, keep=("row_id",), weather_rows=sites,
                              calendar=cal)
        rows = written_by_meter(encoded_frame(fr, bundle.encoders, nulls))
        broken = [name for i, (name, _) in enumerate(rules) if entry.value(f"r{i}")]
        if broken:
            raise AssertionError(f"Bad value: meter {broken[0]}")
        first, last = entry.value("first"), entry.value("last")
        if first is None or (years[0] <= first and last <= years[1]):
            break
        years = (min(first, years[0]), max(last, years[1]))  # rows outside the weather's years: their holidays too
    if on_nulls == "raise":
        pr.raise_on_nulls(nulls.counts)
    return Scored(predict_rows(rows, bundle), nulls.value("rows"), nulls.counts)
