"""Operator 11 against whole-text encoding, its own plan and small brute-force optima."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattlake.llm import packing as P
from wattlake.llm.queries import tokenizer_file


def used(patterns, room):
    out = np.zeros(room + 1, np.int64)
    for p, n in patterns:
        assert n > 0 and sum(p) <= room
        for x in p:
            out[x] += n
    return out


def padding(patterns, room):
    return sum(n * (P.padded(sum(p), room) - sum(p)) for p, n in patterns)


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 40), (2, 3000), (3, 60000)])
def test_plan_uses_every_length_and_pads_little(seed, n):
    rng = np.random.default_rng(seed)
    lengths = np.exp(rng.normal(6.5, 0.9, n)).astype(int) % 2048 + 1
    count = np.bincount(lengths, minlength=2049)
    got = P.plan(count)
    assert (used(got, 2048) == count).all()
    if n >= 3000:
        assert padding(got, 2048) < 0.004 * lengths.sum()


def test_plan_reaches_the_smallest_padding_of_small_stocks():
    room = 16
    patterns = [p for k in range(1, 4) for p in itertools.combinations_with_replacement(range(1, room + 1), k) if sum(p) <= room]
    rng = np.random.default_rng(5)
    for _ in range(10):
        # built from full patterns, so a plan without padding exists
        count = np.zeros(room + 1, np.int64)
        for i in rng.choice([i for i, p in enumerate(patterns) if sum(p) == room], 4):
            for x in patterns[i]:
                count[x] += 50
        got = P.plan(count, room=room, gap=0.0)
        assert (used(got, room) == count).all()
        assert padding(got, room) <= 3 * room  # only what rounding leaves over


def test_one_hot_length_and_empty_stock():
    count = np.zeros(2049, np.int64)
    assert P.plan(count) == []
    count[700], count[2048] = 100_000, 7
    got = P.plan(count)
    assert (used(got, 2048) == count).all() and sum(n for _, n in got) <= 50_008


def check(rows, docs, end, room):
    tok = Tokenizer.from_file(tokenizer_file())
    want = {}
    for d in docs:
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [end]
        want.setdefault(d.doc_id, []).append(ids)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    expect = sorted(((d is None, d or 0), s, min(room, len(i) - s), crc(i[s:s + room]), len(i))
                    for d, x in want.items() for i in x for s in range(0, len(i), room))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expect
    seq = {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return seq


def test_pieces_and_sequences(spark, docs):
    packed = P.pack(docs, tokenizer_file(), end=1, room=256, with_ids=True)
    rows = packed.collect()
    seq = check(rows, docs.collect(), 1, 256)
    made = {r.sequence_id: r for r in P.sequences(packed, room=256, pad=9).collect()}
    assert set(made) == set(seq)
    for s, parts in seq.items():
        r = made[s]
        ids = np.frombuffer(bytes(r.ids), "<u4")
        n = sum(x for _, x in parts)
        assert r.n_ids == n and len(ids) == P.padded(n, 256) and (ids[n:] == 9).all()
        assert r.offsets == sorted(o for o, _ in parts)
    for r in rows:
        at = np.frombuffer(bytes(made[r.sequence_id].ids), "<u4")[r.offset:r.offset + r.length]
        assert zlib.crc32(at.tobytes()) == r.ids_crc32


def test_empty_table_and_hot_group(spark, docs, empty, tmp_path):
    assert P.pack(empty, tokenizer_file()).count() == 0
    one = docs.where("doc_id = 1")
    copies = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("copy").repartition(5)
    copies.write.parquet(str(tmp_path / "hot"))
    hot = spark.read.parquet(str(tmp_path / "hot"))
    rows = P.pack(hot, tokenizer_file()).collect()
    seq = check(rows, hot.collect(), 1, 2048)
    assert len(seq) <= 3000 / (2048 // rows[0].length) + 2
