"""Cubic fills: against a dense solve, and split series against whole ones."""

import datetime as dt

import numpy as np
import pytest

from wattlake.operators import spline as S
from wattlake.operators import timeseries as ts


def dense(x, y, xq):
    """The not-a-knot system written out and solved by numpy."""
    n, h, sl = len(x), np.diff(x), np.diff(y) / np.diff(x)
    a, r = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1:i + 2] = h[i], 2 * (h[i - 1] + h[i]), h[i - 1]
        r[i] = 3 * (h[i] * sl[i - 1] + h[i - 1] * sl[i])
    d0, d1 = x[2] - x[0], x[-1] - x[-3]
    a[0, :2], a[-1, -2:] = (h[1], d0), (d1, h[-2])
    r[0] = ((h[0] + 2 * d0) * h[1] * sl[0] + h[0] ** 2 * sl[1]) / d0
    r[-1] = (h[-1] ** 2 * sl[-2] + (2 * d1 + h[-1]) * h[-2] * sl[-1]) / d1
    return S.evaluate(x, y, np.linalg.solve(a, r), xq)


@pytest.mark.parametrize("n", [4, 5, 6, 7, 31, 400])
def test_slopes_equal_a_dense_solve(n):
    rng = np.random.default_rng(n)
    x, y = np.cumsum(rng.integers(1, 9, n)).astype(float), rng.normal(size=n)
    xq = np.linspace(x[0], x[-1], 500)
    assert np.allclose(S.evaluate(x, y, S.knot_slopes(x, y), xq), dense(x, y, xq), atol=1e-11)


def test_tridiagonal_with_several_right_sides():
    rng = np.random.default_rng(0)
    n = 37
    lower, upper = rng.normal(size=n), rng.normal(size=n)
    diag = 2.5 + np.abs(lower) + np.abs(upper)
    m = np.diag(diag) + np.diag(lower[1:], -1) + np.diag(upper[:-1], 1)
    rhs = rng.normal(size=(n, 3))
    assert np.allclose(m @ S.solve_tridiagonal(lower, diag, upper, rhs), rhs)


def series(spark):
    rng, start, rows = np.random.default_rng(1), dt.datetime(2024, 1, 1), []
    # dense, sparse, almost empty, a hole of a week, three knots, none
    for site, share in enumerate([.9, .3, .02, .5, 0, 0]):
        for h in range(260):
            v = [float(rng.normal()) if rng.random() < share else None for _ in range(2)]
            if site == 3 and 40 < h < 208:
                v = [None, None]
            if site == 4 and h in (10, 90, 200):
                v = [float(h), None]
            rows.append((site, start + dt.timedelta(hours=h), *v, "keep"))
    rows += [(None, start + dt.timedelta(hours=h), v, None, None) for h, v in ((0, 1.0), (1, None), (2, 3.0))]
    return spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, a double, b double, other string").repartition(3).checkpoint()


@pytest.mark.parametrize("chunk", [7, 48, 1000])
def test_split_series_equal_whole_ones(spark, chunk):
    df = series(spark)
    whole, split = ({(r.site_id, r.timestamp): r for r in ts.interpolate_cubic(df, ["a", "b"], chunk_hours=c).collect()}
                    for c in (None, chunk))
    assert whole.keys() == split.keys() and len(whole) == df.count()
    for k, w in whole.items():
        assert split[k].other == w.other
        for c in ("a", "b"):
            assert (w[c] is None) == (split[k][c] is None), (k, w, split[k])
            assert w[c] is None or abs(w[c] - split[k][c]) < 1e-9


def test_split_cubic_of_an_empty_table(spark):
    assert ts.interpolate_cubic(series(spark).where("false"), ["a"], chunk_hours=24).count() == 0


def test_workers_get_the_package(spark):
    """The spline runs on workers that do not have the package on their path: it is sent with the job."""
    ts.interpolate_cubic(series(spark), ["a"])
    assert any(f.endswith("wattlake.zip") for f in spark.sparkContext.listFiles)
