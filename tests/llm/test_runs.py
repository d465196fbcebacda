"""Operator 12 against brute force."""

from __future__ import annotations

import hashlib
import re
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as hs

from wattlake.llm import runs as R
from wattlake.llm.textvec import words_of

SF = "/root/testdata/sf0.001"


def brute(w):
    """All runs (start, length, period): maximal stretches by every distance, with that smallest period."""
    out, n = [], len(w)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j + p - i
            if length >= max(6, 4 * p):
                s = w[i:i + length]
                if all(any(s[k] != s[k + q] for k in range(length - q)) for q in range(1, p)):
                    out.append((i, length, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expect(doc_id, text, rewrite):
    w = words(text)
    numbers = rewrite(doc_id, len(w)) if rewrite and w else None
    if numbers is not None:
        w = [w[i] for i in numbers]
    found = brute(w)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def got(docs_of_words):
    texts = [" ".join(w).encode() for w in docs_of_words]
    h, off = words_of(texts, lower=False)
    start, length, period = R.runs_of(h, off)
    out = [[] for _ in texts]
    for s, n, p in zip(start.tolist(), length.tolist(), period.tolist()):
        i = int(np.searchsorted(off, s, side="right")) - 1
        out[i].append((s - int(off[i]), n, p))
    return out


@settings(max_examples=150, deadline=None)
@given(hs.lists(hs.lists(hs.sampled_from("ab"), max_size=60), min_size=1, max_size=4))
def test_two_words(texts):
    assert got(texts) == [brute(w) for w in texts]


@settings(max_examples=80, deadline=None)
@given(hs.lists(hs.tuples(hs.lists(hs.sampled_from("abc"), min_size=1, max_size=7), hs.integers(1, 9)), max_size=8))
def test_powers(parts):
    w = [x for unit, n in parts for x in unit * n]
    assert got([w, w[::-1], w + w]) == [brute(w), brute(w[::-1]), brute(w + w)]


def test_long_chains_stay_linear():
    n = 200_000
    assert got([["a"] * n]) == [[(0, n, 1)]]
    unit = [f"w{i}" for i in range(1000)]
    assert got([["x"] + unit * 60 + ["y"] + unit * 5]) == [[(1, 60_000, 1000), (60_002, 5000, 1000)]]
    # one line a thousand times, each time after another word: many left words, no run
    line = "one two three four five six seven".split()
    assert got([[x for i in range(3000) for x in [f"n{i}", *line]]]) == [[]]


def test_table(spark, docs, empty):
    rows = [r for r in docs.collect()]
    for rewrite in (None, R.planted):
        out = [tuple(r)[:8] for r in R.digest(R.collapse(docs, rewrite)).collect()]
        small = [r for r in rows if len(words(r.text)) < 1000]
        want = [expect(r.doc_id, r.text, rewrite) for r in small]
        ids = {r.doc_id for r in small}
        key = lambda r: str(r)
        assert sorted((r for r in out if r[0] in ids), key=key) == sorted(want, key=key)
        assert len(out) == len(rows)
    assert R.digest(R.collapse(empty)).count() == 0


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {r[0]: tuple(r)[:8] for r in R.digest(R.collapse(docs, R.planted)).collect()}
    rows = docs.collect()
    assert len(out) == len(rows)
    runs = 0
    for r in rows:
        if len(words(r.text)) < 1500:
            assert out[r.doc_id] == expect(r.doc_id, r.text, R.planted)
            runs += out[r.doc_id][1]
    assert runs
