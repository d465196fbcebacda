"""Operators 6 and 7 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import setjoin, substrings
from wattlake.llm.components import components
from wattlake.llm.store import new_store

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sets(rows, k=5):
    out = []
    for r in rows:
        w = SPACE.findall(lower(r.text))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute_components(rows, num=75, den=100):
    s, n = sets(rows), len(rows)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if s[i] and s[j] and den * len(s[i] & s[j]) >= num * len(s[i] | s[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            low[find(i)] = min(low.get(find(i), r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(s[i]), low.get(find(i))) for i, r in enumerate(rows)), key=str)


def test_join_edge_cases(docs):
    out = setjoin.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, out), key=str) == brute_components(docs.collect())


def test_join_random_near_copies(spark, tmp_path):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for base in range(12):
        text = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 8, 12, 20, 60]))]
        for _ in range(rng.choice([1, 4, 15])):
            t = list(text)
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(t)))
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    d = spark.read.parquet(path)
    out = setjoin.near_duplicates(d).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, out), key=str) == brute_components(d.collect())
    kept = {r.doc_id for r in setjoin.keep_one(d).collect()}
    assert kept == {c for _, _, c in brute_components(d.collect())}


def test_pigeonhole_never_loses_a_link():
    """Any two sets within H share an index key that one of them probes, at every size and for weak bands."""
    rng = np.random.default_rng(5)
    bands = setjoin.Bands(75, 100, 0.75)
    for size in [*range(1, 40), 100, 333]:
        for _ in range(8):
            a = np.unique(rng.integers(0, 1 << setjoin.HASH_BITS, size, dtype=np.uint64))
            drop = rng.integers(0, max(1, size // 4) + 1)
            keep = rng.permutation(a)[drop:]
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << setjoin.HASH_BITS, drop, dtype=np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
                continue
            v, off = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            key, doc, up, seg_size, parts = setjoin.segments(v, off, bands)
            seen = np.array([np.sum(key == k) for k in key])
            alive = np.ones(2, bool)
            probe, double, short, left, own = setjoin._allocate(off, key, doc, up, seg_size, seen, bands, alive)
            assert left.all()
            weak = tuple(range(0, 60))
            for w in (weak, ()):
                if not w and (setjoin._needs(off, doc, up, seg_size, bands)[1] < setjoin._needs(off, doc, up, seg_size, bands)[0]).any():
                    continue
                k, d, p = setjoin._rows_of(v, key, doc, up, parts, seen, probe, double, short, left, own, w)
                for me in (0, 1):
                    assert set(k[(d == me) & p]) & set(k[d == 1 - me])


def test_join_empty(empty):
    assert setjoin.near_duplicates(empty).count() == 0
    assert setjoin.keep_one(empty).count() == 0


def brute_repeats(rows, window):
    seen, out = set(), []
    for r in rows:
        w = SPACE.findall(r.text or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((r.doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window,share", [(20, 0.25), (20, 0.0), (5, 0.25)])
def test_repeats_edge_cases(docs, window, share):
    rows = sorted(docs.withColumn("at", F.monotonically_increasing_id()).collect(),
                  key=lambda r: (r.doc_id is None, r.doc_id or 0, r.at))
    out = substrings.remove_repeats(docs, window=window, group_share=share, seed=min(5, window)).collect()
    assert sorted(map(tuple, out), key=str) == sorted(brute_repeats(rows, window), key=str)


def test_repeats_text_and_periods(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(2, "a b " * 30), (1, "a b " * 12), (3, "q " * 19)], "doc_id long, text string").write.parquet(path)
    d = spark.read.parquet(path)
    out = substrings.remove_repeats(d, text_out=True).collect()
    rows = sorted(d.collect(), key=lambda r: r.doc_id)
    assert sorted(map(tuple, [r[:4] for r in out])) == sorted(brute_repeats(rows, 20))
    assert {r.doc_id: hashlib.sha256(r.kept.encode()).hexdigest() for r in out} == {r.doc_id: r.kept_sha256 for r in out}


def test_repeats_empty(empty):
    assert substrings.remove_repeats(empty).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)], "a long, b long")
    got = {r.node: r.component for r in components(edges, new_store(spark, "t"), "x").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
