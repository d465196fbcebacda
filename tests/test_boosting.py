"""The booster: Spark's trees, a full budget of rounds, and an end only after rounds without a better validation error."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from wattlake.operators import boosting, ml

FEATS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    n = 1500
    x = np.stack([rng.normal(size=n), rng.integers(0, 7, n) * 1.0, rng.exponential(size=n)], 1)
    y = np.sin(2 * x[:, 0]) + 0.3 * x[:, 1] * (x[:, 2] > 1) + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(*map(float, a), float(b), i % 5 == 0) for i, (a, b) in enumerate(zip(x, y))],
                               "x1 double, x2 double, x3 double, y double, held boolean").repartition(3).cache()
    df.count()
    return df


def _predictions(model, df):
    return {r.y: r.prediction for r in model.transform(ml.assembler(FEATS).transform(df)).select("y", "prediction").collect()}


def test_same_trees_as_spark(rows):
    params = dict(maxIter=12, maxDepth=3, stepSize=0.1, minInstancesPerNode=3)
    d = ml.assembler(FEATS).transform(rows)
    theirs = GBTRegressor(featuresCol=ml.FEATURES_COL, labelCol="y", **params).fit(d.where("not held"))
    ours = ml.gbt(FEATS, "y", params | {"patience": 100}, "held").fit(rows).stages[-1]
    assert len(ours.treeWeights) == 12
    a = theirs.evaluateEachIteration(d.where("held"), "squared")
    b = ours.evaluateEachIteration(d.where("held"), "squared")
    assert np.allclose(a, b, atol=1e-7), (a, b)
    assert np.allclose(theirs.featureImportances.toArray(), ours.featureImportances.toArray(), atol=1e-6)


def test_profiles_hold_the_whole_budget(rows):
    assert (ml.GBT_PROFILES["a"]["maxIter"], ml.GBT_PROFILES["b"]["maxIter"]) == (10_000, 1_000)
    model = ml.gbt(FEATS, "y", "a", "held").fit(rows).stages[-1]
    errors = model.evaluateEachIteration(ml.assembler(FEATS).transform(rows.where("held")), "squared")
    assert len(errors) > 25  # the budget before
    assert errors[-1] == min(errors)


def test_bad_rounds_within_the_patience_do_not_end_a_model():
    b = boosting.Booster(0, boosting.setting(1, maxIter=100, patience=3), 1, True, True)
    seen = []
    for e in (9.0, 8.0, 8.5, 8.6, 7.0, 7.0, 7.5, 7.2, 1.0):
        if b.done:
            break
        b.scored(e, 1)
        seen.append(e)
    assert b.best == 5 and len(seen) == 8  # three rounds without a better one, an equal one among them


def test_all_rounds_without_validation_rows(rows):
    model = ml.gbt(FEATS, "y", dict(maxIter=30, maxDepth=2, patience=1)).fit(rows).stages[-1]
    assert len(model.treeWeights) == 30


def test_level_by_level_grows_the_same_models(rows, monkeypatch):
    params = dict(maxIter=11, maxDepth=3, subsamplingRate=0.7, featureSubsetStrategy="0.6", patience=50)
    whole = ml.gbt(FEATS, "y", params, "held").fit(rows).stages[-1]
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    for small in (boosting.SMALL_BYTES, 0):  # histograms meet on the driver, then by key
        monkeypatch.setattr(boosting, "SMALL_BYTES", small)
        levels = ml.gbt(FEATS, "y", params, "held").fit(rows).stages[-1]
        a, b = _predictions(whole, rows), _predictions(levels, rows)
        assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_a_worker_without_state_applies_the_trees_it_lacks(tmp_path):
    bins = np.array([[0, 1, 2, 3, 3, 2]], np.uint8)
    trees = [boosting.Tree([0, -1, -1], [c, 0, 0], [1, 0, 0], [0.0, -1.0, float(c)], 1) for c in range(3)]
    given = boosting.setting(1, maxDepth=1, stepSize=0.5)
    want = sum((1.0 if i == 0 else 0.5) * t.value[np.where(bins[0] <= i, 1, 2)] for i, t in enumerate(trees))

    class Held:
        value = trees[:2]
    for known in (None, 1, 3):
        state = boosting._State(str(tmp_path), 7, 6)
        if known:  # an older, then a current file of the block
            r = boosting.Request(0, 0, given, known, 0, 0, 1, boosting.Tree(), trees[:known], 0, [])
            state.load(r)
            state.advance(r, bins)
            state.save(r)
        r = boosting.Request(0, 0, given, 3, 0, 0, 1, boosting.Tree(), trees[2:], 2, [(0, 2, Held)])
        state = boosting._State(str(tmp_path), 7, 6)
        state.load(r)
        state.advance(r, bins)
        assert np.allclose(state.pred, want)


def test_candidate_splits_see_rare_values_and_all_rows(spark):
    df = spark.range(20_000).select((F.col("id") % 1000 == 0).cast("double").alias("rare"),
                                    F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).cast("double").alias("wide"))
    rare, wide = boosting.candidate_splits(df, ["rare", "wide"])
    assert list(rare) == [0.5]
    assert len(wide) == boosting.BINS - 1
    assert np.allclose(wide, np.arange(1, boosting.BINS) * 20_000 / boosting.BINS, atol=20)


def test_null_features_go_right_as_in_the_model(spark):
    df = spark.createDataFrame([(None if i % 4 == 0 else float(i % 4), float(i % 4 == 0)) for i in range(80)], "x double, y double")
    model = ml.gbt(["x"], "y", dict(maxIter=3, maxDepth=3)).fit(df)
    got = {r.x: r.prediction for r in model.transform(df).select("x", "prediction").distinct().collect()}
    assert abs(got[3.0] - got[None]) < 1e-12 and got[1.0] < got[None]


def test_null_labels_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None)], "x double, y double")
    with pytest.raises(Exception, match="null or not a number"):
        ml.gbt(["x"], "y", dict(maxIter=2)).fit(df)


def test_a_torn_state_file_counts_as_none(tmp_path):
    bins = np.array([[0, 1, 2, 3]], np.uint8)
    tree = boosting.Tree([0, -1, -1], [1, 0, 0], [1, 0, 0], [0.0, -1.0, 1.0], 1)
    r = boosting.Request(0, 0, boosting.setting(1, maxDepth=1), 1, 0, 0, 1, boosting.Tree(), [tree], 0, [])
    for _ in range(2):
        state = boosting._State(str(tmp_path), 3, 4)
        state.load(r)
        state.advance(r, bins)
        assert list(state.pred) == [-1.0, -1.0, 1.0, 1.0]
        state.save(r)
        (path,) = tmp_path.iterdir()
        raw = bytearray(path.read_bytes())
        raw[40] ^= 1
        path.write_bytes(raw)


def test_search_scores_each_trial_at_its_best_round(rows):
    space = {"stepSize": ("choice", [0.05]), "maxDepth": ("int", 2, 4), "subsamplingRate": ("uniform", 0.5, 1.0)}
    got = ml.random_search(rows.where("not held"), rows.where("held"), FEATS, "y", space, n_trials=3, max_iter=60, patience=5).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3]
    assert [r.msle for r in sorted(got, key=lambda r: r["rank"])] == sorted(r.msle for r in got)
    params = ml.sample_params(space, 3)
    data = boosting.prepare(rows, FEATS, "y", "held")
    grown = boosting.boost(data, [boosting.setting(3, maxIter=60, patience=5, **p) for p in params])
    for r in got:
        b = grown[r.trial]
        assert len(b.trees) > 20  # the budget before
        model = boosting.spark_model(rows.sparkSession, b, data.splits, ml.FEATURES_COL, "y")
        pred = model.transform(ml.assembler(FEATS).transform(rows.where("held")))
        assert abs(ml.rmsle(pred, "y", "prediction", scale="log").first()["msle"] - r.msle) < 1e-5


def test_registered_search_runs_its_whole_budget(spark, monkeypatch):
    from conftest import SF_SMALL
    from wattlake.plans import q_pipelines as q
    seen = []

    def watched(data, settings, keep=True, boost=boosting.boost):
        seen.extend(settings)
        return boost(data, settings, keep)
    monkeypatch.setattr(boosting, "boost", watched)
    monkeypatch.setattr(q, "fitted", None)  # the search needs the encoders, not the models
    out = q.q_random_search(spark, SF_SMALL).collect()
    assert len(seen) == len(out) == 50
    assert {(s.rounds, s.patience) for s in seen} == {(5_000, 10)}


def test_search_without_validation_rows_is_an_error(rows):
    with pytest.raises(ValueError, match="validation"):
        ml.random_search(rows, rows.limit(0), FEATS, "y", n_trials=1)
