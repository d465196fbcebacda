"""Operator 13 against counting in plain Python."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from wattlake.llm import phrases as P

SF = "/root/testdata/sf0.001"


def brute(rows, least, share, top):
    """rows: (text, lang)."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in cand.items():
            if len(p) == 3:
                inside |= {q for q in (p[:2], p[1:]) if q in cand and 100 * a >= share * cand[q]}
        rows_ = []
        for p, a in cand.items():
            if p not in inside:
                score, _, left, right = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def texts(seed, n, words):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        out.append(("".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?"]) for x in w),
                    rng.choice(["en", "de", None, "und", ""])))
    return out


@pytest.mark.parametrize("least,share,top", [(2, 50, 30), (10, 50, 2000), (1, 90, 2000)])
def test_random_texts(spark, least, share, top):
    rows = [*texts(1, 150, ["the", "The", "cat", "sat", "été", "Été", "　x", "a\x00b", "\x1c"]), (None, "en"), ("", "fr"), (" . ", "fr")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, n int, shard string").repartition(3)
    assert result(P.collocations(df, least, share, top)) == brute(rows, least, share, top)


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    got = result(P.collocations(docs))
    assert got == brute(rows, 10, 50, 2000) and got


def test_given_rows_empty_table_and_many_languages(spark, docs, empty):
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert result(P.collocations(docs, 2, 50, 2000)) == brute(rows, 2, 50, 2000)
    assert P.collocations(empty).count() == 0
    many = [("a b c. a b", f"l{i}") for i in range(300)]
    df = spark.createDataFrame(many, "text string, lang string")
    assert result(P.collocations(df, 2, 50, 5)) == brute(many, 2, 50, 5)


def test_hot_pair(spark):
    rows = [(" ".join(["hot pair", f"x{i % 50}"] * 20), "en") for i in range(400)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert result(P.collocations(df)) == brute(rows, 10, 50, 2000)


def test_buffers_cut_long_texts_at_piece_ends(monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 40)
    t = b"one two, three four five six. seven eight; " * 30
    parts = [b for _, b in P._buffers({"text": [t, None], "lang": ["en", "en"]})]
    assert len(parts) > 10 and b"\n".join(parts) == t.lower().translate(P._ENDS)


def test_equal_states_are_registered_once_and_scores_are_exact():
    size = np.array([1, 2, 1, 2, 0, 0, 2])
    word, count = np.array([7, 1, 2, 7, 1, 2, 1, 2]), np.array([1, 1, 1, 1, 1, 1, 1, 3])
    same, own = P._registered(size, word, count)
    assert same.tolist() == [0, 1, 0, 1, 4, 4, 6] and own.tolist() == [0, 1, 4, 6]
    a = 3 * 10**15
    assert P._cut(a, (a, a + 1), (a + 1, a)) == (1_000_000 * a * a // (a * (a + 1)), a, a + 1)
