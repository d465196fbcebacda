"""Encoder stages, saved models, and the scoring job: one pass over the meter table, null report, rules."""

import datetime as dt
import json
import os
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wattlake.operators import bundle as bd
from wattlake.operators import encoders as enc
from wattlake.operators import profiling as pr
from wattlake.operators import stages
from wattlake.plans import pipelines as pl
from wattlake.session import scratch_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# ------------------------------------------------------------------ encoder stages

def frame(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), int(rng.integers(0, 3)), f"u{rng.zipf(1.5) % 14}" if rng.random() > .1 else None, f"c{rng.integers(0, 3)}",
             float(1e6 + rng.normal()), None if rng.random() < .2 else float(rng.integers(0, 5)), 7.0, float(rng.gamma(2.0)))
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, meter int, use string, country string, big double, gap double, flat double, y double")


CATS, NUMS = ["use", "country"], ["big", "gap", "flat"]


def encoder():
    return stages.FeatureEncoder(catCols=CATS, numCols=NUMS, by=["meter"], target="y", minCategories=4)


def values(df):
    return {r.row_id: [r[c] for c in CATS + NUMS] for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-6), (k, a[k], b[k])


def test_one_read_equals_three_fits(spark):
    df = frame(spark).checkpoint()
    rare = enc.RareLabelEncoder(CATS, by=["meter"], n_categories=4).fit(df)
    d1 = rare.transform(df)
    mean = enc.MeanTargetEncoder(CATS, "y", by=["meter"]).fit(d1)
    d2 = mean.transform(d1)
    want = enc.StandardScaler(CATS + NUMS, by=["meter"]).fit(d2).transform(d2)
    got = encoder().fit(df).transform(df)
    close(values(got), values(want))
    given = dict(catCols=CATS, numCols=NUMS, by=["meter"], target="y", minCategories=4)
    step = Pipeline(stages=[stages.RareLabelEstimator(**given), stages.MeanTargetEstimator(**given),
                            stages.ScalerEstimator(**given)]).fit(df).transform(df)
    close(values(step), values(want))


def test_fit_scans_the_rows_once(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    table = stages.group_table(df, ["meter"], CATS, NUMS, "y")
    assert scans(table, str(tmp_path / "rows")) == 1
    model = encoder().fit(df)
    for s in model.stages:
        assert scans(s.state, str(tmp_path / "rows")) == 0


def test_pipeline_of_encoders_saves_and_loads(spark, tmp_path):
    df = frame(spark).checkpoint()
    model = encoder().fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert [type(s).__name__ for s in again.stages] == ["RareLabelModel", "MeanTargetModel", "ScalerModel"]
    assert [s.uid for s in again.stages] == [s.uid for s in model.stages]
    close(values(again.transform(df)), values(model.transform(df)))
    encoder().write().overwrite().save(str(tmp_path / "e"))
    close(values(stages.FeatureEncoder.load(str(tmp_path / "e")).fit(df).transform(df)), values(model.transform(df)))


# ------------------------------------------------------------------ scoring

def scans(df, path):
    """Scans of a path in the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Scan parquet" in line and path in line for line in plan.split("== Initial Plan ==")[-1].splitlines())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("scoring"))
    rng = np.random.default_rng(1)
    hours = 24 * 12
    start = dt.datetime(2016, 12, 25)
    val = lambda x: None if rng.random() < .1 else float(x)
    weather = [(s, start + dt.timedelta(hours=h), val(10 * np.sin(h / 24) + s), val(5 * np.sin(h / 24)), val(1010 + s), val(h % 360),
                val(3.0)) for s in (0, 1, 5, 2) for h in range(hours)]
    building = [(b, [0, 1, 5, 2][b % 4], f"use{b % 3}", 1000 + 100 * b, None if b % 5 == 0 else 1950.0 + b, 2.0) for b in range(20)]
    # local time is up to eight hours behind: readings stay inside it
    meter = [(i, int(rng.integers(0, 20)), int(rng.integers(0, 4)), start + dt.timedelta(hours=int(rng.integers(0, hours - 10))),
              float(rng.gamma(3.0) * 50)) for i in range(1500)]
    for name, rows, schema in (
            ("weather", weather, "site_id int, timestamp timestamp_ntz, air_temperature double, dew_temperature double, "
                                 "sea_level_pressure double, wind_direction double, wind_speed double"),
            ("building", building, "building_id long, site_id int, primary_use string, square_feet int, year_built double, floor_count double"),
            ("meter", meter, "row_id long, building_id long, meter int, timestamp timestamp_ntz, meter_reading double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}")
    return base


def read(spark, base, name):
    df = spark.read.parquet(f"{base}/{name}")
    return df.drop("meter_reading") if name == "meter" else df


def trained(spark, base):
    w = pl.weather_pipeline(read(spark, base, "weather"), dt.datetime(2016, 12, 25), dt.datetime(2017, 1, 5, 23))
    fr = pl.training_frame(spark.read.parquet(f"{base}/meter"), w, read(spark, base, "building")).checkpoint()
    encoding, models, _ = pl.fit_models(fr, dict(maxIter=3, maxDepth=3))
    area = fr.groupBy("meter").agg(F.avg("square_feet").alias(bd.AREA_COLUMN))
    return bd.ModelBundle(encoding, models, area, pl.MODEL_INPUTS)


@pytest.fixture(scope="module")
def saved(spark, tables):
    path = scratch_dir(spark, "t-models")
    b = trained(spark, tables)
    assert b.save(spark, path) == 1
    return b, path


def inputs(spark, base):
    return [read(spark, base, n) for n in ("meter", "weather", "building")]


def result(df):
    return {r.row_id: r.meter_reading for r in df.collect()}


NEW_SESSION = """
import sys
sys.path.insert(0, {root!r})
from wattlake.session import get_session
from wattlake.plans import pipelines as pl
spark = get_session("local[2]", shuffle_partitions=4)
read = lambda n: spark.read.parquet({base!r} + "/" + n)
out = pl.score(read("meter").drop("meter_reading"), read("weather"), read("building"), {path!r}, meter_limits={{"meter": (0, 3)}})
out.coalesce(1).write.parquet({out!r})
"""


def test_scores_from_a_path_in_a_new_session(spark, tables, saved, tmp_path):
    b, path = saved
    here = result(pl.score(*inputs(spark, tables), b, meter_limits={"meter": (0, 3)}))
    assert len(here) == 1500 and all(v is not None and v >= 0 for v in here.values())
    out = str(tmp_path / "scored")
    code = NEW_SESSION.format(root=ROOT, base=tables, path=path, out=out)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    there = result(spark.read.parquet(out))
    assert there.keys() == here.keys() and all(abs(there[k] - here[k]) <= 1e-9 * max(1, here[k]) for k in here)


def test_versions_and_unfinished_saves(spark, saved):
    b, _ = saved
    path = scratch_dir(spark, "t-versions")
    with pytest.raises(FileNotFoundError):
        bd.load(spark, path)
    assert [b.save(spark, path), b.save(spark, path)] == [1, 2]
    # a save that died before its manifest is not a version
    b.mean_area.write.parquet(f"{path}/version=3/mean_area")
    assert bd.versions(spark, path) == [1, 2]
    got = bd.load(spark, path)
    assert got.version == 2 and sorted(got.models) == [0, 1, 2, 3] and list(got.features) == pl.MODEL_INPUTS
    assert bd.load(spark, path, 1).version == 1
    with pytest.raises(FileNotFoundError):
        bd.load(spark, path, 3)
    manifest = json.loads(spark.read.text(f"{path}/version=2/manifest").first()[0])
    assert manifest["meters"] == [0, 1, 2, 3]
    assert b.save(spark, path) == 3  # and is written over


def test_one_scan_of_the_meter_table(spark, tables, saved):
    b, _ = saved
    meter, weather, building = inputs(spark, tables)
    w = pl.weather_pipeline(weather, dt.datetime(2016, 12, 25), dt.datetime(2017, 1, 5, 23))
    from wattlake.operators import holidays as hol
    nulls = pr.NullReport()
    fr = pl.feature_pipeline(meter, w, pl.building_clean(building), feats=pl.MODEL_FEATURES, keep=("row_id",),
                             weather_rows=1152, calendar=hol.holiday_calendar(spark, [2016, 2017]))
    encoded = pl.encoded_frame(fr, b.encoders, nulls)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert scans(encoded, f"{tables}/meter") == 1
    assert scans(encoded, f"{tables}/weather") <= 2  # the grid's sites and the values
    assert "CollectMetrics" in plan
    rows = pl.written_by_meter(encoded)
    pred = pl.predict_rows(rows, b)
    assert scans(pred, f"{tables}/meter") == 0
    text = pred._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(meter") >= 4
    assert nulls.value("rows") == 1500


def test_null_report_raises_or_is_returned(spark, tables, saved):
    b, _ = saved
    meter, weather, building = inputs(spark, tables)
    fewer = building.where("building_id <> 7")
    lost = meter.where("building_id = 7").count()
    assert lost
    with pytest.raises(AssertionError, match="square_feet"):
        pl.score(meter, weather, fewer, b, meter_limits={"meter": (0, 3)})
    got = pl.score_report(meter, weather, fewer, b, on_nulls="report", meter_limits={"meter": (0, 3)})
    assert got.rows == 1500 and got.nulls["square_feet"] == got.nulls["primary_use"] == lost and got.nulls["building_id"] == 0
    assert got.predictions.count() == 1500
    with pytest.raises(ValueError):
        pl.score(meter, weather, building, b, on_nulls="ignore")


def test_rules_unknown_meters_and_other_years(spark, tables, saved):
    b, _ = saved
    meter, weather, building = inputs(spark, tables)
    with pytest.raises(AssertionError, match="building_id <= 10"):
        pl.score(meter, weather, building, b, meter_limits={"building_id": (0, 10)})
    odd = meter.withColumn("meter", F.when(F.col("row_id") < 10, 9).when(F.col("row_id") < 20, F.lit(None)).otherwise(F.col("meter")))
    got = result(pl.score(odd, weather, building, b, on_nulls="report", meter_limits={"building_id": (0, 99)}))
    assert len(got) == 1500 and all((v is None) == (k < 20) for k, v in got.items())
    # a row in a year that the weather does not have: its holiday flag comes from a wider calendar
    late = meter.withColumn("timestamp", F.when(F.col("row_id") == 0, F.lit("2021-07-04 05:00:00").cast("timestamp_ntz"))
                            .otherwise(F.col("timestamp")))
    rep = pl.score_report(late, weather, building, b, on_nulls="report", meter_limits={"meter": (0, 3)})
    assert rep.rows == 1500 and rep.nulls["is_holiday"] == 0 and rep.nulls["wind_speed"] == 1


# ------------------------------------------------------------------ one-hot vectors

def test_dictionary_vectors(spark, tmp_path):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["b", "a", None, "c", "a", "é"])], "id int, c string")
    model = stages.DictionaryEstimator(inputCol="c", outputCol="v", handleUnseen="keep").fit(df)
    model.write().overwrite().save(str(tmp_path / "d"))
    more = df.unionByName(spark.createDataFrame([(9, "new")], "id int, c string"))
    for m in (model, stages.DictionaryModel.load(str(tmp_path / "d"))):
        got = {r.id: r.v for r in m.transform(more).collect()}
        assert {k: (v.size, list(v.indices), list(v.values)) for k, v in got.items()} == {
            0: (5, [1], [1.0]), 1: (5, [0], [1.0]), 2: (5, [4], [1.0]), 3: (5, [2], [1.0]), 4: (5, [0], [1.0]), 5: (5, [3], [1.0]),
            9: (5, [4], [1.0])}
    strict = stages.DictionaryEstimator(inputCol="c").fit(df)
    known = df.where("c is not null")
    assert {r.one_hot.size for r in strict.transform(known).collect()} == {4}
    with pytest.raises(Exception, match="not in the dictionary: new"):
        strict.transform(more.where("id = 9")).collect()
    with pytest.raises(ValueError, match="more than 3"):
        stages.DictionaryEstimator(inputCol="c", maxCategories=3).fit(df)
    assert Pipeline(stages=[stages.DictionaryEstimator(inputCol="c", handleUnseen="keep")]).fit(df).transform(df).count() == 6
