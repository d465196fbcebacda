"""Order statistics, numbers, runs and fingerprints: against numpy and plain Python."""

import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.operators import impute
from wattlake.operators import profiling as pr
from wattlake.operators.joins import align_by_position
from wattlake.operators.numbering import numbered

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(n=4000, seed=5):
    rng = np.random.default_rng(seed)
    ties = rng.integers(0, 4, n).astype(float)
    ties[: n // 2] = 1.5  # half of all rows are one value
    return {"normal": rng.normal(size=n), "wide": np.sign(rng.normal(size=n)) * 10.0 ** rng.uniform(-300, 300, n), "ties": ties,
            "one": np.full(n, -0.0), "close": 1e9 + rng.integers(0, 50, n) * 2.0 ** -22, "tiny": rng.integers(-3, 4, n) * 5e-324}


def test_radix_quantiles_equal_numpy(spark):
    data = columns()
    rng = np.random.default_rng(9)
    holes = {c: rng.random(len(v)) < 0.2 for c, v in data.items()}
    rows = [tuple(None if holes[c][i] else float(v[i]) for c, v in data.items()) + (None,) for i in range(len(data["normal"]))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data) + ", nothing double").repartition(5).checkpoint()
    got = pr.radix_quantiles(df, [*data, "nothing"], PROBS)
    assert got["nothing"] == [None] * len(PROBS)
    for c, v in data.items():
        want = np.quantile(v[~holes[c]], PROBS)
        assert np.allclose(got[c], want, rtol=1e-12, atol=0), c
    assert pr.radix_quantiles(df.where("false"), ["ties"], [0.5]) == {"ties": [None]}
    # integers, and one row
    assert pr.radix_quantiles(spark.createDataFrame([(7,)], "x int"), ["x"], [0.3]) == {"x": [7.0]}


def test_order_key_is_monotonic(spark):
    rng = np.random.default_rng(0)
    raw = [struct.unpack("<d", rng.bytes(8))[0] for _ in range(2000)] + [0.0, -0.0, 5e-324, -5e-324, float("inf"), float("-inf"), 1.0, -1.0]
    xs = sorted(x for x in raw if x == x)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").select("x", pr.order_key(F.col("x")).alias("k"))
    got = sorted((r.x, r.k) for r in df.collect())
    for (a, ka), (b, kb) in zip(got, got[1:]):
        assert (a < b) == (ka < kb) and (a == b) == (ka == kb)


def test_quantiles_read_the_rows_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x")).repartition(3).checkpoint()
    got = pr.radix_quantiles(df.mapInArrow(note, "x double"), ["x"], [0.25, 0.5])
    assert got["x"] == list(np.quantile(np.arange(1000) % 37, [0.25, 0.5])) and seen.value == 2000


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_medians_from_counts(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(0, 5)), f"u{rng.integers(0, 4)}", None if rng.random() < .4 else float(rng.integers(1900, 1925)))
            for i in range(300)] + [(900, 7, "u9", None), (901, None, "u1", None), (902, 8, None, None), (903, 8, "u9", 1950.0)]
    df = spark.createDataFrame(rows, "building_id long, site_id int, primary_use string, year_built double")

    def fill(values, key):
        groups = {}
        for r, v in zip(rows, values):
            if v is not None:
                groups.setdefault(r[key], []).append(v)
        return [v if v is not None or r[key] is None or r[key] not in groups else float(np.median(groups[r[key]]))
                for r, v in zip(rows, values)]

    one = fill([r[3] for r in rows], 1)
    got = {r.building_id: r.year_built for r in impute.impute_group_median(df, "year_built", "site_id").collect()}
    assert got == {r[0]: v for r, v in zip(rows, one)}
    last = fill(fill(one, 2), 1)
    got = {r.building_id: r.year_built for r in impute.impute_year_built(df).collect()}
    assert got == {r[0]: None if v is None else int(v) for r, v in zip(rows, last)}


def test_building_clean_reads_the_buildings_once_in_its_plan(spark, tmp_path):
    from wattlake.plans import pipelines as pl
    spark.createDataFrame([(i, i % 3, f"u{i % 2}", 1000, None if i % 4 == 0 else 1900.0 + i, 1.0) for i in range(40)],
                          "building_id long, site_id int, primary_use string, square_feet int, year_built double, floor_count double"
                          ).write.parquet(str(tmp_path / "b"))
    out = pl.building_clean(spark.read.parquet(str(tmp_path / "b")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "percentile" not in plan
    assert out.where("year_built is null").count() == 0


@pytest.mark.parametrize("partitions", [1, 6])
def test_numbers_without_a_window_over_the_group(spark, partitions):
    rows = [(g, (i * 7919) % 5000) for g, n in (("hot", 5000), ("small", 3), (None, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(4)
    out = numbered(df, ["g"], ["v"], partitions=partitions)
    got = {}
    for r in out.collect():
        got.setdefault(r.g, []).append((r.pos, r.v))
    for g, part in got.items():
        part.sort()
        assert [p for p, _ in part] == list(range(len(part))) and [v for _, v in part] == sorted(v for h, v in rows if h == g)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan
    if partitions > 1:  # the hot group is in many partitions
        assert out.select("pos").count() == len(rows)


def test_ragged_lists_of_one_long_meter(spark):
    rows = [(0, b) for b in range(2000)] + [(1, 5), (1, 3)]
    out = align_by_position(spark.createDataFrame(rows, "meter int, building_id int").repartition(5), "meter", "building_id").collect()
    got = {r.pos: (r.meter_0, r.meter_1) for r in out}
    assert len(got) == 2000 and got[0] == ("0", "3") and got[1] == ("1", "5") and got[1999] == ("1999", "")


def test_presence_runs_expand_to_the_dense_map(spark):
    rng, start = np.random.default_rng(4), dt.datetime(2016, 1, 1)
    rows = [(b, m, start + dt.timedelta(hours=int(h)), None if rng.random() < .1 else float(rng.integers(-1, 3)))
            for b in range(5) for m in (0, 2) for h in sorted(rng.choice(40, 25)) if (b, m) != (3, 2)]
    df = spark.createDataFrame(rows, "building_id long, meter int, timestamp timestamp_ntz, meter_reading double")
    want = {}
    for m in (0, 2):
        for t in {r[2] for r in rows if r[1] == m}:
            for b in range(5):
                v = [r[3] for r in rows if r[:3] == (b, m, t) and r[3] is not None]
                want[b, m, t] = int(np.sign(max(v))) if v else None
    got = {(r.building_id, r.meter, r.timestamp): r.presence for r in pr.presence_map(df).collect()}
    assert got == want
    runs = pr.presence_runs(df).collect()
    assert sum(r.hours for r in runs) == len(want)
    by = {}
    for r in runs:
        by.setdefault((r.building_id, r.meter), []).append((r.first, r.last, r.presence))
    for part in by.values():
        part.sort(key=lambda x: x[0])
        assert part[0][0] == 0
        for a, b in zip(part, part[1:]):
            assert b[0] == a[1] + 1 and a[2] != b[2]  # no gap, and the longest possible
    assert len(by[3, 2]) == 1
    one = pr.presence_map(df, 2)
    assert one.count() == sum(k[1] == 2 for k in want)
    assert pr.presence_runs(df.where("false")).count() == 0


def test_duplicate_columns_by_fingerprints(spark):
    rows = [(i % 3, i % 3, (i + 1) % 3, None if i % 5 == 0 else i % 3, None if i % 5 == 0 else i % 3, str(i % 3)) for i in range(60)] * 2
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int, f string").repartition(4)
    got = {(r.col1, r.col2) for r in pr.duplicate_features(df).collect() if r.equal}
    assert got == {("a", "b"), ("d", "e")}
    # the same values in another order are not equal
    swapped = spark.createDataFrame([(1, 2), (2, 1)], "x int, y int")
    assert not pr.duplicate_features(swapped).first().equal
    assert pr.duplicate_features(swapped.where("false")).first().equal
