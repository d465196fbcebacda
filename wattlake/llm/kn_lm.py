"""Interpolated modified Kneser-Ney word model over the whole corpus (operator 3).

Bigram model: P(w | v) = max(c(v,w) - D(c), 0) / c(v) + g(v) P(w) and
P(w) = max(N(w) - D'(N), 0) / N + l / (V + 1), where N(w) counts the distinct
words before w and N all distinct bigrams; the discounts D1, D2, D3+ come from
the counts of counts, and an unknown word gets l / (V + 1).  Every text starts
after a start mark (never predicted) and ends with an end mark (predicted).

*Counting in Spark.*  A task turns a chunk of training texts into its distinct
bigrams with counts and sends them packed, grouped by first word, to the shard
of (first word, second word); a frequent first word spreads over ``SPLIT``
shards.  Shards merge the blocks, write the model and send partial word totals
to word shards.  Nothing is pruned, so shuffle and model grow with the corpus.

*Sorted hash arrays.*  A bigram shard is a sorted array of 64-bit bigram keys
with their counts; a word shard is a range of the word hashes with the word's
counts.  They are ``.npy`` files in the shared folder.

*Scoring.*  Tasks memory-map the arrays and look up the sorted distinct words
and bigrams of a chunk, shard by shard, so that each page is touched once per
chunk; no task holds the model.

Null text: empty (one token, the end mark).  Null doc_id: its checksum is that
of the empty string.  Repeated rows count each time.  Extra columns are ignored.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.textvec import U64, chunks, mix, words_of

CHUNK = 16 << 20
SPLIT = 4
#: Hash of the end and start marks; no word hashes to them but by a 2**-64 chance.
END, START = U64(0x2545F4914F6CDD1D), U64(0x9E6C63D0876A9A47)
_WORD = ("word", "count", "before", "n1", "n2", "n3")


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous token, token, offsets) of all positions to predict, end marks included."""
    h, off = words_of(texts, lower=True)
    n = len(off) - 1
    out = off + np.arange(n + 1)
    tok = np.empty(int(out[-1]), U64)
    ends = out[1:] - 1
    inner = np.ones(len(tok), bool)
    inner[ends] = False
    tok[inner], tok[ends] = h, END
    ctx = np.empty_like(tok)
    ctx[1:] = tok[:-1]
    ctx[out[:-1]] = START
    return ctx, tok, out


def pair_key(ctx: np.ndarray, tok: np.ndarray) -> np.ndarray:
    return mix(ctx * U64(0xC2B2AE3D27D4EB4F) + mix(tok + U64(1)))


def pair_shard(ctx: np.ndarray, tok: np.ndarray, n: int) -> np.ndarray:
    """Shards in rows of SPLIT: the first word picks the row, the second the place in it."""
    split = min(SPLIT, n)
    return ((ctx >> U64(32)) % U64(n // split) * U64(split) + (tok >> U64(32)) % U64(split)).astype(np.int64)


def word_shard(word: np.ndarray, n: int) -> np.ndarray:
    """Ranges of the hash, so that the shards in order are one sorted array."""
    return ((word >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def held_out(doc_id, modulo: int, held: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulo == held


def _small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    top = int(a.max(initial=0))
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else U64)


def _dump(*arrays: np.ndarray) -> bytes:
    buf = io.BytesIO()
    for a in arrays:
        np.lib.format.write_array(buf, np.ascontiguousarray(a), allow_pickle=False)
    return buf.getvalue()


def _load(data: bytes, n: int) -> list[np.ndarray]:
    buf = io.BytesIO(data)
    return [np.lib.format.read_array(buf, allow_pickle=False) for _ in range(n)]


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)


def _count_pairs(batches, n_shards: int, modulo: int, held: int) -> Iterator[pa.RecordBatch]:
    """Distinct training bigrams of each chunk, packed by shard and first word."""
    pid = ex.pid()
    for c, cols in enumerate(chunks(batches, "text", CHUNK)):
        train = [t or b"" for t, d in zip(cols["text"], cols["doc_id"]) if not held_out(d, modulo, held)]
        ctx, tok, _ = tokens(train)
        if not len(tok):
            continue
        key = pair_key(ctx, tok)
        order = np.argsort(key)
        first = _runs(key[order])
        n = np.diff(np.append(first, len(key)))
        lead = order[first]
        v, w = ctx[lead], tok[lead]
        order = np.lexsort((v, pair_shard(v, w, n_shards)))
        v, w, n = v[order], w[order], n[order]
        shard = pair_shard(v, w, n_shards)
        bounds = np.searchsorted(shard, np.arange(n_shards + 1))
        full, data = [], []
        for s in range(n_shards):
            lo, hi = bounds[s], bounds[s + 1]
            if hi > lo:
                f = _runs(v[lo:hi])
                full.append(s)
                data.append(_dump(v[lo:hi][f], _small(np.diff(np.append(f, hi - lo))), w[lo:hi], _small(n[lo:hi])))
        yield ex.rows(full, pid, c, data)


def _merge_pairs(batches, n_shards: int, store: str) -> Iterator[pa.RecordBatch]:
    """Write each bigram shard; send its partial word totals to the word shards."""
    got = ex.gathered(batches)
    i = 0
    while i < len(got):
        s, j = got[i][0], i
        parts = []
        while j < len(got) and got[j][0] == s:
            v, runs, w, n = _load(got[j][3], 4)
            got[j] = None
            parts.append((np.repeat(v, runs), w, n.astype(np.int64)))
            j += 1
        i = j
        v, w, n = (np.concatenate(x) for x in zip(*parts))
        del parts
        key = pair_key(v, w)
        order = np.argsort(key)
        first = _runs(key[order])
        n = np.add.reduceat(n[order], first)
        lead = order[first]
        key, v, w = key[lead], v[lead], w[lead]
        st.put_arrays(store, f"pairs/{s}", key=key, n=_small(n))
        # totals: the second word's count and distinct predecessors, the first word's successors by count
        words = np.concatenate([w, v])
        add = np.zeros((5, len(words)), np.int64)
        add[0, :len(w)], add[1, :len(w)] = n, 1
        for k in (1, 2):
            add[1 + k, len(w):] = n == k
        add[4, len(w):] = n > 2
        word, add = _sum_by(words, add)
        bounds = np.searchsorted(word_shard(word, n_shards), np.arange(n_shards + 1))
        full = [t for t in range(n_shards) if bounds[t + 1] > bounds[t]]
        yield ex.rows(full, s, 0, [_dump(word[bounds[t]:bounds[t + 1]], *(_small(x[bounds[t]:bounds[t + 1]]) for x in add))
                                   for t in full])
        # counts of counts of this shard, under a shard of their own
        yield ex.rows([-1], s, 0, [np.array([np.sum(n == k) for k in (1, 2, 3, 4)], np.int64).tobytes()])


def _sum_by(words: np.ndarray, add: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words, kind="stable")
    first = _runs(words[order])
    return words[order][first], np.stack([np.add.reduceat(x[order], first) for x in add]) if len(words) else add


def _merge_words(batches, store: str) -> Iterator[pa.RecordBatch]:
    """Write each word shard; report the totals the formulas need."""
    by: dict[int, list] = {}
    counts = np.zeros(4, np.int64)
    for s, _, _, data in ex.gathered(batches):
        if s < 0:
            counts += np.frombuffer(data, np.int64)
        else:
            by.setdefault(s, []).append(_load(data, 6))
    total = np.zeros(9, np.int64)
    for s, parts in by.items():
        cols = [np.concatenate(x) for x in zip(*parts)]
        word, sums = _sum_by(cols[0], np.stack([x.astype(np.int64) for x in cols[1:]]))
        st.put_arrays(store, f"words/{s}", word=word, **{n: _small(x) for n, x in zip(_WORD[1:], sums)})
        seen = sums[0] > 0  # the start mark is never a token
        total += np.array([sums[0].sum(), seen.sum(), sums[1].sum(), *(np.sum(sums[1] == k) for k in (1, 2, 3, 4)),
                           np.sum(sums[1] > 2), len(word)])
    yield pa.RecordBatch.from_arrays(
        [pa.array([int(x)]) for x in (*total, *counts)], names=[f"t{i}" for i in range(13)])


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) of modified Kneser-Ney; counts of counts of zero fall back to 0.5 k / (k + 1)."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [0.0]
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and b else k / (k + 1)
        out.append(min(max(d, 0.05), k - 0.05 if k > 1 else 0.95))
    return np.array(out)


class Model:
    """The memory-mapped model, as a worker sees it."""

    def __init__(self, store: str, n_shards: int, totals: dict):
        self.store, self.n = store, n_shards
        self.tokens, self.vocab, self.bigrams = totals["tokens"], totals["vocab"], totals["bigrams"]
        self.d2, self.d1 = np.array(totals["d2"]), np.array(totals["d1"])
        self.rest = totals["rest"] / max(self.bigrams, 1) if self.bigrams else 1.0
        self.held: dict = {}

    def _map(self, folder: str, s: int, keys: tuple) -> list[np.ndarray] | None:
        at = (folder, s)
        if at not in self.held:
            try:
                self.held[at] = [st.map_array(self.store, f"{folder}/{s}", k) for k in keys]
            except FileNotFoundError:  # no training bigram fell into this shard
                self.held[at] = None
        return self.held[at]

    @staticmethod
    def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_keys, wanted), max(len(sorted_keys) - 1, 0))
        return at, (sorted_keys[at] == wanted) if len(sorted_keys) else np.zeros(len(wanted), bool)

    def words(self, wanted: np.ndarray) -> np.ndarray:
        """(count, before, n1, n2, n3) of sorted distinct words; zeros if unknown."""
        out = np.zeros((5, len(wanted)), np.int64)
        shard = word_shard(wanted, self.n)
        bounds = np.searchsorted(shard, np.arange(self.n + 1))
        for s in np.unique(shard).tolist():
            cols = self._map("words", s, _WORD)
            if cols is not None:
                lo, hi = bounds[s], bounds[s + 1]
                at, ok = self._find(cols[0], wanted[lo:hi])
                for i in range(5):
                    out[i, lo:hi][ok] = cols[i + 1][at[ok]]
        return out

    def pairs(self, key: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Counts of distinct bigrams, sorted by (shard, key)."""
        out = np.zeros(len(key), np.int64)
        bounds = np.searchsorted(shard, np.arange(self.n + 1))
        for s in np.unique(shard).tolist():
            cols = self._map("pairs", s, ("key", "n"))
            if cols is not None:
                lo, hi = bounds[s], bounds[s + 1]
                at, ok = self._find(cols[0], key[lo:hi])
                out[lo:hi][ok] = cols[1][at[ok]]
        return out

    def score(self, ctx: np.ndarray, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 P(tok | ctx), training count of tok) of every position."""
        both, place = np.unique(np.concatenate([tok, ctx]), return_inverse=True)
        count, before, n1, n2, n3 = self.words(both)
        low = np.maximum(before - self.d1[np.minimum(before, 3)], 0) / max(self.bigrams, 1) + self.rest / (self.vocab + 1)
        # a word is followed by as many tokens as it occurs; the start mark by one for each text
        follow = np.where(both == START, self.starts, count)
        follow[both == END] = 0
        gap = (self.d2[1] * n1 + self.d2[2] * n2 + self.d2[3] * n3) / np.maximum(follow, 1)
        gap[follow == 0] = 1.0
        t, v = place[:len(tok)], place[len(tok):]
        key, shard = pair_key(ctx, tok), pair_shard(ctx, tok, self.n)
        order = np.lexsort((key, shard))
        first = _runs(key[order])
        c = np.empty(len(key), np.int64)
        c[order] = np.repeat(self.pairs(key[order][first], shard[order][first]), np.diff(np.append(first, len(key))))
        p = np.maximum(c - self.d2[np.minimum(c, 3)], 0) / np.maximum(follow[v], 1) + gap[v] * low[t]
        return np.log10(p), count[t]

    @property
    def starts(self) -> int:
        """Training texts: as many as end marks."""
        if "ends" not in self.held:
            self.held["ends"] = int(self.words(np.array([END], U64))[0, 0])
        return self.held["ends"]


def _score(batches, store: str, n_shards: int, totals: dict, modulo: int, held: int) -> Iterator[pa.RecordBatch]:
    model = Model(store, n_shards, totals)
    base_total = np.log10(model.tokens + (model.vocab + 1))
    for cols in chunks(batches, "text", CHUNK):
        ctx, tok, off = tokens([t or b"" for t in cols["text"]])
        logp, count = model.score(ctx, tok)
        base = np.log10(count + 1) - base_total
        at = off[:-1]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(cols["doc_id"], pa.int64()),
            "held_out": pa.array([held_out(d, modulo, held) for d in cols["doc_id"]], pa.bool_()),
            "n_tokens": pa.array(np.diff(off)), "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(at), model.tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(logp, at))})


def train(docs: DataFrame, store: str, n_shards: int, modulo: int, held: int) -> dict:
    """Count ``docs`` into the model files; returns the totals the formulas need."""
    blocks = docs.mapInArrow(partial(_count_pairs, n_shards=n_shards, modulo=modulo, held=held), ex.BLOCK_SCHEMA)
    words = blocks.repartitionById(n_shards, "shard").mapInArrow(
        partial(_merge_pairs, n_shards=n_shards, store=store), ex.BLOCK_SCHEMA)
    # rows of counts of counts (shard -1) join the last word shard's task
    words = words.withColumn("to", F.when(F.col("shard") < 0, n_shards - 1).otherwise(F.col("shard")))
    names = [f"t{i}" for i in range(13)]
    t = (words.repartitionById(n_shards, "to").drop("to")
         .mapInArrow(partial(_merge_words, store=store), ", ".join(f"{n} long" for n in names))
         .agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)).first())
    d1, d2 = _discounts(t.t3, t.t4, t.t5, t.t6), _discounts(t.t9, t.t10, t.t11, t.t12)
    rest = float(d1[1] * t.t3 + d1[2] * t.t4 + d1[3] * t.t7)
    return {"tokens": t.t0, "vocab": t.t1, "bigrams": t.t2, "d1": d1.tolist(), "d2": d2.tolist(), "rest": rest}


def score_documents(docs: DataFrame, modulo: int = 7, held: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id bigint, text string): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    store = st.new_store(spark, "kn")
    src = st.scanned(docs, store).select("doc_id", F.col("text").cast("binary").alias("text"))
    n_shards = max(SPLIT, st.shards_of(src) // SPLIT * SPLIT)
    totals = train(src, store, n_shards, modulo, held)
    return src.mapInArrow(
        partial(_score, store=store, n_shards=n_shards, totals=totals, modulo=modulo, held=held),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
