from __future__ import annotations

import numpy as np
import pytest

from wattlake.llm import ann


def recall(rows, out, k=20, every=20):
    """Share of the true neighbours that were found; checks ranks, order and scores on the way (distinct ids)."""
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = 0
    for q in np.flatnonzero(ids % every == 0):
        s = (x * x[q]).sum(1)
        exact = s.copy()
        s[q] = -np.inf
        best = np.lexsort((ids, -s))[:k]
        mine = sorted(got[ids[q]])
        assert [m[0] for m in mine] == list(range(1, k + 1)) and mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        assert len({m[1] for m in mine}) == k
        for m in mine:
            want = exact[np.flatnonzero(ids == m[1])[0]]
            assert abs(want - m[2]) <= 1e-12 * max(1.0, abs(want))
        found += len({m[1] for m in mine} & set(ids[best].tolist()))
    return found / (k * len(got))


def test_recall_scores_and_order(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in v.collect()]
    assert recall(rows, ann.nearest(v).collect()) >= 0.95


@pytest.mark.parametrize("length", [1e-9, 1e4, 1e6, 1e20, 1e200])
def test_one_vector_of_another_length(spark, length):
    """The lists of the other vectors, and so the recall, do not change."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    odd = rng.normal(size=24)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100_001, (odd / np.sqrt((odd * odd).sum()) * length).tolist())]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert recall(rows, out) >= 0.95


@pytest.mark.parametrize("clusters", [0, 12])
def test_unequal_lengths(spark, clusters):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    if clusters:
        x = x * 0.2 + rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 1500)] * 2
    x *= np.exp(rng.normal(size=1500))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert recall(rows, out) >= 0.95


def test_classes_that_the_sample_lacks(spark):
    """All but one vector have lengths that the sample does not know: they share the list that is scanned whole."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * 2.0 ** (i % 40)).tolist()) for i in range(200)]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=10, max_fit=1).collect()
    assert recall(rows, out, k=10) == 1.0


def test_repeated_vec_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5])] + [(i, rng.normal(size=2).tolist()) for i in range(1, 39)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, row int, score string")
    out = [r for r in ann.nearest(df).collect() if r.query_id == 0]
    # two query rows, each with 20 results; the other row of vec_id 0 is a candidate
    assert sorted(r["rank"] for r in out) == sorted([*range(1, 21)] * 2)
    by_id = {}
    for r in out:
        by_id.setdefault(r.vec_id, []).append(r.score)
    assert len(by_id) == 20 and all(len(s) == 2 for s in by_id.values()) and by_id[0] == [1.25, 1.25]


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [-1.0, 0.5]), (None, [1.0, 1.0]), (40, []), (9, [1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(v).collect())
    assert out == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (0, 4, 8, -1.0),
                   (20, 1, 8, 1.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert ann.nearest(v.where("vec_id = 3")).count() == 0


def test_block_copies_and_ties(spark):
    v = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(300)], "vec_id long, embedding array<double>")
    out = ann.nearest(v, k=5, every=100, block_rows=16).collect()
    assert sorted(r.vec_id for r in out if r.query_id == 0) == [1, 2, 3, 4, 5]
