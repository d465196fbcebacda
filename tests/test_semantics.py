"""Hand-computed checks of the semantic decisions (nulls, calendars,
reindex, interpolation, scaling)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake import functions as fn
from wattlake.operators import encoders as enc
from wattlake.operators import filters as flt
from wattlake.operators import holidays as hol
from wattlake.operators import profiling as pr
from wattlake.operators import timeseries as ts

T0 = dt.datetime(2024, 1, 1)


def h(i):
    return T0 + dt.timedelta(hours=i)


def test_drop_nonpositive_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -1.0), (3, None), (4, 2.5)], "id int, meter_reading double")
    assert sorted(r.id for r in flt.drop_nonpositive(df).collect()) == [3, 4]


def test_weekday_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 7, 5),)], "timestamp timestamp_ntz")
    r = fn.date_parts(df).collect()
    assert [x.dayofweek for x in r] == [0, 6]
    assert [x["hour"] for x in r] == [5, 5]


def test_clip_and_blend_nulls(spark):
    df = spark.createDataFrame([(-1.0, 2.0), (None, 4.0), (3.0, None)], "a double, b double")
    r = df.select(fn.clip_min(F.col("a"), 0.0).alias("c"), fn.blend({"a": 0.5, "b": 0.5}).alias("m")).collect()
    assert [x.c for x in r] == [0.0, None, 3.0]
    assert [x.m for x in r] == [0.5, 4.0, 3.0]


def test_reindex_fills_grid_and_drops_outside(spark):
    rows = [(0, h(0), 1.0), (0, h(2), 3.0), (0, h(10), 9.0), (1, h(1), 5.0)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, v double")
    out = ts.reindex_time(df, h(0), h(3)).orderBy("site_id", "timestamp").collect()
    assert len(out) == 8
    assert [x.v for x in out if x.site_id == 0] == [1.0, None, 3.0, None]


def test_reindex_rejects_duplicates(spark):
    rows = [(0, h(0), 1.0), (0, h(0), 2.0)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, v double")
    with pytest.raises(Exception):
        ts.reindex_time(df, h(0), h(1)).collect()


def test_linear_interpolation_and_edges(spark):
    vals = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([(0, h(i), v) for i, v in enumerate(vals)], "site_id int, timestamp timestamp_ntz, v double")
    out = ts.interpolate_linear(df, ["v"]).orderBy("timestamp").collect()
    assert [x.v for x in out] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_ffill_bfill_all_null_group_stays_null(spark):
    rows = [(0, h(0), None), (0, h(1), 2.0), (0, h(2), None), (1, h(0), None)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, v double")
    out = {(x.site_id, x.timestamp): x.v for x in ts.ffill_bfill(df, ["v"]).collect()}
    assert out[(0, h(0))] == 2.0 and out[(0, h(2))] == 2.0 and out[(1, h(0))] is None


def test_spline_reproduces_cubic():
    x = np.arange(50, dtype=float)
    y = 1 + 2 * x / 50 - 3 * (x / 50) ** 2 + (x / 50) ** 3
    known = np.ones_like(x, dtype=bool)
    known[[3, 4, 10, 11, 12, 30]] = False
    yy = np.where(known, y, np.nan)
    filled = ts.spline_fill_series(yy)
    assert np.allclose(filled, y, atol=1e-12)


def test_spline_few_points_falls_back_to_linear():
    yy = np.array([np.nan, 0.0, np.nan, 2.0, np.nan])
    assert ts.spline_fill_series(yy).tolist()[1:4] == [0.0, 1.0, 2.0]


def test_cubic_operator_matches_closed_form(spark):
    rows = []
    for s in (0, 1):
        for i in range(40):
            u = i / 40
            v = None if i % 7 in (3, 4) and 0 < i < 39 else 1 + s + 2 * u - 3 * u * u + u ** 3
            rows.append((s, h(i), v, 1 + s + 2 * u - 3 * u * u + u ** 3))
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, v double, truth double")
    out = ts.interpolate_cubic(df, ["v"]).collect()
    assert max(abs(r.v - r.truth) for r in out) < 1e-9


def test_copy_site_column(spark):
    rows = [(1, h(0), 1000.0), (1, h(1), 1001.0), (5, h(0), None), (5, h(1), None), (2, h(0), 990.0)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, p double")
    out = {(r.site_id, r.timestamp): r.p for r in ts.copy_site_column(df, "p", 1, 5).collect()}
    assert out[(5, h(0))] == 1000.0 and out[(5, h(1))] == 1001.0 and out[(2, h(0))] == 990.0


def test_local_time_offsets(spark):
    df = spark.createDataFrame([(0, h(10)), (2, h(10)), (99, h(10))], "site_id int, timestamp timestamp_ntz")
    out = {r.site_id: r.timestamp for r in ts.to_local_time(df).collect()}
    assert out[0] == h(5) and out[2] == h(3) and out[99] is None


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    out = {r.bin: r["count"] for r in pr.histogram(df, "x", 5).collect()}
    assert out == {0: 2, 1: 2, 2: 1, 3: 0, 4: 1}


def test_scaler_uses_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (0, 3.0, 5.0)], "meter int, a double, b double")
    m = enc.StandardScaler(["a", "b"], by=("meter",)).fit(df)
    out = sorted((r.a, r.b) for r in m.transform(df).collect())
    assert out == [(-1.0, 0.0), (1.0, 0.0)]


def test_rare_label_rules(spark):
    # 12 categories (> 10): the one with share < 5 % becomes Rare, unseen -> Rare
    rows = [(0, f"c{i}") for i in range(11) for _ in range(10)] + [(0, "tiny")]
    df = spark.createDataFrame(rows, "meter int, use string")
    m = enc.RareLabelEncoder(["use"], by=("meter",)).fit(df)
    new = spark.createDataFrame([(0, "tiny"), (0, "c1"), (0, "unseen")], "meter int, use string")
    assert [r.use for r in m.transform(new).orderBy("use").collect()] == ["Rare", "Rare", "c1"]
    # few categories: all kept even if rare
    small = spark.createDataFrame([(0, "a")] * 99 + [(0, "b")], "meter int, use string")
    m2 = enc.RareLabelEncoder(["use"], by=("meter",)).fit(small)
    assert {r.use for r in m2.transform(small).collect()} == {"a", "b"}


def test_holiday_dates(spark):
    cal = hol.holiday_calendar(spark, [2016, 2017, 2018, 2021, 2022, 2024])
    days = {(r.country, r.holiday_date) for r in cal.collect()}
    d = dt.date
    for c, day in [("US", d(2024, 1, 15)), ("US", d(2024, 11, 28)), ("US", d(2021, 12, 31)),
                   ("US", d(2021, 7, 5)), ("UK", d(2024, 3, 29)), ("UK", d(2024, 4, 1)),
                   ("UK", d(2024, 1, 2)), ("CA", d(2024, 5, 20)), ("CA", d(2016, 3, 25)),
                   ("IE", d(2024, 3, 18)), ("IE", d(2017, 10, 30)), ("UK", d(2016, 12, 27))]:
        assert (c, day) in days, (c, day)
    assert ("US", d(2024, 1, 16)) not in days


def test_null_assert_raises(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    with pytest.raises(AssertionError):
        pr.assert_no_nulls(df)


def test_nth_group_uses_distinct_members(spark):
    rows = [(0, b) for b in [5, 5, 7, 9, 11]] + [(1, 3)]
    df = spark.createDataFrame(rows, "meter int, building_id int")
    out = sorted({(r.meter, r.building_id) for r in flt.nth_group(df, 1, 3).collect()})
    assert out == [(0, 7), (0, 9)]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.zeros(500), [np.nan] * 10])
    df = spark.createDataFrame([(None if np.isnan(v) else float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = pr.exact_quantiles(df, "x", probs, accuracy=100)
    ref = np.quantile(vals[~np.isnan(vals)], probs)
    assert np.allclose(got, ref, rtol=0, atol=1e-12)


def test_exact_quantiles_multi_columns(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 50, 2000).astype(float), rng.exponential(size=2000)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = pr.exact_quantiles_multi(df, ["a", "b"], [0.25, 0.5, 0.9], accuracy=50)
    assert np.allclose(got["a"], np.quantile(a, [0.25, 0.5, 0.9]), atol=1e-12)
    assert np.allclose(got["b"], np.quantile(b, [0.25, 0.5, 0.9]), atol=1e-12)


@pytest.mark.parametrize("chunk", [1, 5, 24])
def test_chunked_fill_equals_single_window(spark, chunk):
    rng = np.random.default_rng(11)
    rows = []
    for s in (0, 1, 2):
        for i in range(60):
            v = None if rng.random() < 0.5 else float(rng.integers(0, 100))
            rows.append((s, h(i), v, None if i % 13 else 1.0))
    rows += [(3, h(i), None, None) for i in range(10)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, a double, b double")
    ref = ts.ffill_bfill(ts.interpolate_linear(df, ["a", "b"]), ["a", "b"])
    got = ts.fill_chunked(df, ["a", "b"], chunk_hours=chunk, method="linear")
    key = lambda r: (r.site_id, r.timestamp)
    for x, y in zip(sorted(ref.collect(), key=key), sorted(got.collect(), key=key)):
        for c in ("a", "b"):
            assert (x[c] is None and y[c] is None) or abs(x[c] - y[c]) < 1e-9, (x, y)
    got_f = ts.fill_chunked(df, ["a"], chunk_hours=chunk, method="ffill")
    ref_f = ts.ffill_bfill(df, ["a"])
    assert sorted(got_f.collect(), key=key) == sorted(ref_f.collect(), key=key)


def test_weather_pipeline_invariants(spark):
    from conftest import SF_SMALL
    from wattlake.plans import pipelines as pl
    from wattlake.sources import fixtures as fx
    raw = fx.weather(spark, SF_SMALL)
    for method in ("linear", "cubic"):
        w = pl.weather_pipeline(raw, fx.INTERVAL_START, fx.INTERVAL_END, cubic_method=method).cache()
        n_sites = raw.select("site_id").distinct().count()
        assert w.count() == n_sites * fx.INTERVAL_HOURS
        assert w.select("site_id", "timestamp").distinct().count() == w.count()
        # site 5 has no pressure of its own: it carries site 1's values hour by hour
        s1 = {r.timestamp: r.sea_level_pressure for r in w.where("site_id = 1").collect()}
        s5 = {r.timestamp: r.sea_level_pressure for r in w.where("site_id = 5").collect()}
        assert s5 and all(s5[t] == s1[t] for t in s5)
        # every series with at least one value is completely filled
        for c in ["air_temperature", "dew_temperature", "wind_speed", "wind_direction"]:
            per = w.groupBy("site_id").agg(F.count(c).alias("n")).collect()
            assert all(r.n in (0, fx.INTERVAL_HOURS) for r in per), (method, c)
        w.unpersist()


def test_reference_bounds_shift_western_sites(spark):
    # bounds taken before the local-time shift: a UTC-5 site loses its first
    # five hours (shifted before the interval) and gets an empty tail that
    # the fill then carries forward
    rows = [(0, h(i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, air_temperature double")
    r = ts.reindex_time(ts.to_local_time(df), h(0), h(9)).orderBy("timestamp").collect()
    assert [x.air_temperature for x in r] == [5.0, 6.0, 7.0, 8.0, 9.0, None, None, None, None, None]
    filled = ts.ffill_bfill(ts.reindex_time(ts.to_local_time(df), h(0), h(9)), ["air_temperature"])
    assert [x.air_temperature for x in filled.orderBy("timestamp").collect()][5:] == [9.0] * 5


def test_exact_quantiles_refine_large_brackets(spark):
    # tiny sketch accuracy and candidate cap force several refinement rounds;
    # a heavily repeated value (a third of the rows) must not block them
    rng = np.random.default_rng(9)
    vals = np.concatenate([rng.normal(size=4000), np.full(2000, 0.5)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.01, 0.3, 0.5, 0.77, 0.999]
    got = pr.exact_quantiles(df, "x", probs, accuracy=20, max_candidates=40)
    assert np.allclose(got, np.quantile(vals, probs), atol=1e-12)


@pytest.mark.parametrize("chunk", [None, 2])
def test_fill_missing_others_variant(spark, chunk):
    rows = [(0, h(0), None, None, None), (0, h(1), 1.0, 5.0, None), (0, h(2), None, None, 7.0),
            (0, h(3), 3.0, None, None)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, lin double, other double, ff double")
    out = ts.fill_missing(df, ffill_cols=["ff"], linear_cols=["lin"], others="ffill", cubic_method="linear",
                          chunk_hours=chunk).orderBy("timestamp").collect()
    assert [r.lin for r in out] == [1.0, 1.0, 2.0, 3.0]
    assert [r.other for r in out] == [5.0, 5.0, 5.0, 5.0]
    assert [r.ff for r in out] == [7.0, 7.0, 7.0, 7.0]
    plain = ts.fill_missing(df, linear_cols=["lin"], cubic_method="linear", chunk_hours=chunk)
    assert [r.other for r in plain.orderBy("timestamp").collect()] == [None, 5.0, None, None]


#: Published holidays of 2024 (US federal, Ontario, all parts of the UK, Ireland), observed days included.
HOLIDAYS_2024 = {
    "US": "01-01 01-15 02-19 05-27 07-04 09-02 10-14 11-11 11-28 12-25",
    "CA": "01-01 02-19 03-29 05-20 07-01 08-05 09-02 10-14 12-25 12-26",
    "UK": "01-01 01-02 03-17 03-18 03-29 04-01 05-06 05-27 07-12 08-05 08-26 11-30 12-25 12-26",
    "IE": "01-01 03-17 03-18 04-01 05-06 06-03 08-05 10-28 12-25 12-26",
}


def test_holidays_of_a_year_against_published_dates(spark):
    got = {}
    for r in hol.holiday_calendar(spark, [2024]).collect():
        got.setdefault(r.country, set()).add(f"{r.holiday_date:%m-%d}")
    assert got == {c: set(d.split()) for c, d in HOLIDAYS_2024.items()}


def test_unbounded_category_lists_are_refused(spark):
    from wattlake.operators import encoders as enc
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id int, c string")
    with pytest.raises(ValueError, match="more than 5"):
        enc.one_hot(df, "c", max_categories=5)
    with pytest.raises(ValueError, match="more than 5"):
        pr.pivot_count(df, "id", "c", max_categories=5)
    assert len(enc.one_hot(df, "c", max_categories=20).columns) == 21


def test_correlation_of_constant_columns_matches_duckdb(spark, duck):
    # 0.1 and 3.3 over uneven partitions: their merged averages need not be exact
    rows = [(float(i), 0.1, 3.3 if i % 3 else None, float(i * i % 17), None, 1.0 if i == 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, c double, d double, y double, empty double, one double").repartition(7).cache()
    duck.execute("create or replace temp table const_src (x double, c double, d double, y double, empty double, one double)")
    duck.executemany("insert into const_src values (?, ?, ?, ?, ?, ?)", rows)
    cols = ["x", "c", "d", "y", "one", "empty"]

    def same(got, want):
        return (got is None) == (want is None) and (got is None or (np.isnan(got) and np.isnan(want)) or abs(got - want) < 1e-9)

    def oracle(a, b):
        return duck.execute(f"select corr({a}, {b}) from const_src").fetchone()[0]

    matrix = {(r.col1, r.col2): r["corr"] for r in pr.correlation_matrix(df, cols).collect()}
    for (a, b), got in matrix.items():
        assert same(got, 1.0 if a == b else oracle(a, b)), (a, b, got)
    assert np.isnan(matrix["x", "c"]) and np.isnan(matrix["x", "one"]) and matrix["x", "empty"] is None
    assert abs(matrix["x", "y"]) < 1
    target = {r.feature: r["corr"] for r in pr.target_correlation(df, "y", cols[:3], threshold=None).collect()}
    assert all(same(v, oracle(c, "y")) for c, v in target.items())
    picked = {(r.method, r.feature) for r in pr.filter_selections(df, ["x", "c", "d"], "y").collect()}
    # NaN orders above every number, here as in the SQL: kept by target_corr, and a later twin of x
    assert {("target_corr", "c"), ("uncorrelated", "x")} <= picked and ("uncorrelated", "c") not in picked
    df.unpersist()
