"""Lasso paths from sufficient statistics: against Spark's solver, refits per fold, and optimality conditions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.operators import linear as L
from wattlake.operators import ml, stages

CATS, NUMS = ["use", "country"], ["a", "b", "flat", "big"]
FEATS = CATS + NUMS


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    rng = np.random.default_rng(2)
    out = []
    for i in range(1600):
        m, u, c = int(rng.integers(0, 2)), int(rng.zipf(1.6)) % 13, int(rng.integers(0, 3))
        a, b, big = float(rng.normal()), float(rng.gamma(2)), float(1e4 + 50 * rng.normal())
        y = 1 + .3 * u + .5 * c + (2 if m else -1) * a + .01 * big + float(rng.normal())
        out.append((i, m, f"u{u}" if i % 50 else None, f"c{c}", a if i % 97 else None, b, 3.5, big, y if i % 101 else None, "x"))
    path = str(tmp_path_factory.mktemp("linear") / "rows")
    spark.createDataFrame(out, "row_id long, meter int, use string, country string, a double, b double, flat double, big double, "
                               "y double, held string").write.parquet(path)
    return ml.fold_column(spark.read.parquet(path), folds=4)


@pytest.fixture(scope="module")
def solved(rows):
    return L.lasso_paths(rows, CATS, NUMS, "y", folds=4, alphas=(0.0, 1e-3, 0.05, 5.0), subsets={"all": FEATS, "ab": ["a", "b"]})


def encoder(df):
    return stages.FeatureEncoder(catCols=CATS, numCols=NUMS, by=["meter"], target="y").fit(df)


def test_equal_to_the_iterative_solver(spark, rows, solved):
    full = rows.dropna(subset=NUMS + ["y"]).checkpoint()
    enc = encoder(full).transform(full).checkpoint()
    for meter in (0, 1):
        for alpha in (0.0, 0.05):
            got = solved.where(f"held = -1 and feature_set = 'all' and meter = {meter}").where(F.col("alpha") == alpha).first()
            m = ml.lasso(FEATS, "y", alpha, max_iter=5000)
            m.getStages()[-1].setTol(1e-14)
            fit = m.fit(enc.where(F.col("meter") == meter)).stages[-1]
            assert np.allclose(got.weights, fit.coefficients.toArray(), atol=1e-6)
            assert abs(got.intercept - fit.intercept) < 1e-6
            assert got.weights[FEATS.index("flat")] == 0.0 and got.msle is None


def test_optimality_of_all_solutions(rows, solved):
    sums = {(r.meter, r.held): r for r in
            L.fold_sums(L.moment_table(rows, ["meter"], CATS, NUMS, "y"), ["meter"], CATS, NUMS, 4).collect()}
    n = 0
    for r in solved.collect():
        s = L.System(np.array(sums[r.meter, r.held].train), len(FEATS), np.array(sums[r.meter, r.held].flat))
        w = np.array(r.weights)
        slope = s.xy - s.gram @ w
        mask = np.array([f in ("a", "b") or r.feature_set == "all" for f in FEATS])
        assert (w[~mask] == 0).all()
        on = w != 0
        assert np.allclose(slope[on], r.alpha * np.sign(w[on]), atol=1e-9)
        assert (np.abs(slope[mask & ~on]) <= r.alpha + 1e-9).all()
        n += 1
    assert n == 2 * 5 * 2 * 4


def test_held_fold_error_equals_refit_and_scored_rows(rows, solved):
    full = rows.dropna(subset=NUMS + ["y"]).checkpoint()
    for held in (0, 3):
        enc = encoder(full.where(F.col("fold") != held))
        scored = enc.transform(full.where(F.col("fold") == held))
        one = solved.where((F.col("held") == held) & (F.col("feature_set") == "all") & (F.col("alpha") == 0.05))
        pred = L.predict(scored, one, FEATS, clip_at_zero=False)
        direct = {r.meter: r for r in ml.rmsle(pred, "y", "prediction", by=["meter"], scale="log").collect()}
        for r in one.collect():
            assert abs(direct[r.meter].msle - r.msle) < 1e-8 and direct[r.meter].n == r.n


def test_one_scan_whatever_the_grid(rows):
    table = L.moment_table(rows, ["meter"], CATS, NUMS, "y")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    # the table does not grow with the rows: groups x folds x category combinations
    assert table.count() <= 2 * 4 * 14 * 3


def test_cross_validation_table(solved):
    got = L.cross_validated(solved).collect()
    assert len(got) == 2 * 2 * 4
    for meter in (0, 1):
        part = sorted((r for r in got if r.meter == meter), key=lambda r: r["rank"])
        assert [r["rank"] for r in part] == list(range(1, 9))
        assert all(round(a.mean_msle, 6) <= round(b.mean_msle, 6) for a, b in zip(part, part[1:]))


def test_predictions_are_clipped_and_keep_unknown_groups(spark, solved):
    one = solved.where("held = -1 and feature_set = 'all'").where(F.col("alpha") == 0.05)
    rows = spark.createDataFrame([(0, *[0.0] * 6), (1, *[-1e6] * 6), (9, *[0.0] * 6)], "meter int, " + ", ".join(f"{f} double" for f in FEATS))
    got = {r.meter: r.prediction for r in L.predict(rows, one, FEATS).collect()}
    assert got[0] > 0 and got[9] is None and got[1] >= 0


def test_empty_table(rows):
    assert L.lasso_paths(rows.where("false"), CATS, NUMS, "y", folds=4).count() == 0


def test_principal_components_equal_numpy(spark, rows):
    got = {}
    for r in L.principal_components(rows, CATS, NUMS, "y", k=3).collect():
        got.setdefault((r.meter, r.component), []).append((r.explained_variance, r.feature, r.loading))
    full = rows.dropna(subset=NUMS + ["y"]).checkpoint()
    enc = encoder(full).transform(full)
    for meter in (0, 1):
        x = np.array([[r[f] for f in FEATS] for r in enc.where(F.col("meter") == meter).collect()], float)
        values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
        for c in range(3):
            assert all(abs(s - values[-1 - c] / values.sum()) < 1e-9 for s, _, _ in got[meter, c])
            v = np.array([w for _, _, w in got[meter, c]])
            assert [f for _, f, _ in got[meter, c]] == FEATS and v[np.abs(v).argmax()] > 0
            assert abs(abs(v @ vectors[:, -1 - c]) - 1) < 1e-9


def test_selections_from_sums(spark, rows):
    got = {}
    for r in L.selections(rows, CATS, NUMS, "y", alpha=0.05).collect():
        got.setdefault((r.meter, r.method), set()).add(r.feature)
    full = rows.dropna(subset=NUMS + ["y"]).checkpoint()
    raw_enc = encoder(full)
    scaled = raw_enc.transform(full)
    coded = raw_enc.stages[1].transform(raw_enc.stages[0].transform(full))
    for meter in (0, 1):
        x = np.array([[r[f] for f in FEATS] for r in coded.where(F.col("meter") == meter).collect()], float)
        pairs = scaled.where(F.col("meter") == meter).collect()
        z, y = np.array([[r[f] for f in FEATS] for r in pairs], float), np.array([r.y for r in pairs])
        corr = z.T @ z / len(z)
        with_y = z.T @ (y - y.mean()) / len(z) / y.std()
        assert got[meter, "variance"] == {f for f, v in zip(FEATS, x.var(0, ddof=1)) if v >= 0.01}
        assert got[meter, "target_corr"] == {f for f, c in zip(FEATS, with_y) if c > 0.1}
        assert got[meter, "uncorrelated"] == {f for j, f in enumerate(FEATS) if not any(corr[i, j] >= 0.8 for i in range(j))}
        fit = lambda fs: np.abs(ml.lasso(fs, "y", 0.05, 5000).fit(scaled.where(F.col("meter") == meter)).stages[-1].coefficients.toArray())
        assert got[meter, "lasso"] == {f for f, w in zip(FEATS, fit(FEATS)) if w >= 1e-5}
        keep = list(FEATS)
        while len(keep) > 3:
            keep.pop(int(fit(keep).argmin()))
        assert got[meter, "rfe_l1"] == set(keep)


def test_side_by_side_table(spark):
    chosen = spark.createDataFrame([(0, "a", "x"), (0, "b", "x"), (0, "b", "y"), (1, "a", "z")], "meter int, method string, feature string")
    got = {(r.meter, r.feature): (r.a, r.b, r.votes) for r in L.side_by_side(chosen, ["x", "y", "z"], ["a", "b"]).collect()}
    assert got == {(0, "x"): (1, 1, 2), (0, "y"): (0, 1, 1), (0, "z"): (0, 0, 0), (1, "x"): (0, 0, 0), (1, "y"): (0, 0, 0), (1, "z"): (1, 0, 1)}
