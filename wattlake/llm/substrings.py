"""Exact removal of repeated word sequences by prefix-partitioned suffix trees (operator 6).

Every word position starts a suffix.  A window is the first ``window`` words of
a suffix inside one document; a window whose words also start earlier (smaller
doc_id, or the same document and an earlier start) is a repeat, and every word
that a repeat covers is removed.  A node of the suffix tree of string depth >=
``window`` with two leaves is exactly such a repeat, so only the part of each
subtree at that depth is built.

1. *Sparse pass.*  A window's anchor is the smallest hash of its ``seed``-word
   grams.  Equal windows have equal anchors, so a suffix whose anchor occurs at
   one place of the corpus is a lone leaf above the wanted depth and needs no
   tree.  Anchors (about 2 in ``window - seed + 2`` positions) are counted
   across the corpus; the same pass counts suffixes per prefix of 1, 2, 4, 8
   and 16 words in a fixed number of buckets.
2. *Prefix partition.*  Each remaining suffix goes to the group of its shortest
   prefix that has at most ``group_size`` suffixes; prefixes that stay frequent
   get longer, up to the whole window.  Groups are dealt over the shards.
   Suffixes with equal windows share the group.  Inside a chunk only the
   earliest suffix of equal windows is sent, so a passage that is everywhere
   costs one row per chunk.
3. *Subtrees.*  A shard sorts its leaves by 128-bit window key (the suffix
   array of a subtree cut at the window's depth); a run of two and more leaves
   is a deep internal node, whose earliest leaf stays.
4. The last pass marks the words covered by repeats.

Order and ties: documents with equal doc_id are ordered by file position; null
doc_ids come last.  Null and empty texts have no words.  Texts shorter than a
window lose nothing.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.textvec import U64, chunks, grams, mix, sliding_min, whole, words_of

CHUNK = 8 << 20
LEVELS = (1, 2, 4, 8, 16)
BUCKETS = 4096
_ENTRY = np.dtype([("k1", "<u8"), ("k2", "<u8"), ("doc", "<i8"), ("pos", "<u4")])
_LAST = np.iinfo(np.int64).max


class _Chunk:
    """Words and window anchors of one chunk of documents."""

    def __init__(self, cols: dict, window: int, seed: int):
        self.texts = [t or b"" for t in cols["text"]]
        self.h, self.off = words_of(self.texts, lower=False)
        self.start = np.flatnonzero(whole(self.off, window))
        g = grams(self.h, seed)
        # value in the high bits, position in the low ones: the minimum names one place
        place = (np.arange(len(g), dtype=U64) & U64(0xFFFFFF))
        low = sliding_min((g & ~U64(0xFFFFFF)) | (U64(0xFFFFFF) - place), window - seed + 1)
        self.anchor_of = low[self.start] if len(self.start) else np.zeros(0, U64)
        self.anchors = np.unique(self.anchor_of)  # one per place
        self.keys = mix(self.anchors >> U64(24))

    def prefixes(self, levels) -> list[np.ndarray]:
        return [grams(self.h, n, salt=n)[self.start] for n in levels]

    def windows(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """128-bit keys of the windows starting at ``at``."""
        return tuple(_at(self.h, at, window, salt) for salt in (101, 202))


def _at(h: np.ndarray, at: np.ndarray, k: int, salt: int) -> np.ndarray:
    m = U64((0xC2B2AE3D27D4EB4F + 2 * salt * 0x165667B19E3779F9) & (2**64 - 1) | 1)
    acc = np.full(len(at), U64(k + salt), U64)
    for j in range(k):
        acc *= m
        acc += h[at + j]
    return mix(acc)


def _bucket(prefix: np.ndarray) -> np.ndarray:
    return (prefix >> U64(52)).astype(np.int64)


def _sparse_pass(batches, window: int, seed: int, n_shards: int, store: str) -> Iterator[pa.RecordBatch]:
    pid, counts = ex.pid(), np.zeros((len(LEVELS), BUCKETS), np.int64)
    levels = [n for n in LEVELS if n < window]
    for c, cols in enumerate(chunks(batches, "text", CHUNK)):
        x = _Chunk(cols, window, seed)
        if len(x.start):
            for i, p in enumerate(x.prefixes(levels)):
                counts[i] += np.bincount(_bucket(p), minlength=BUCKETS)
            yield ex.key_blocks(x.keys, pid, c, n_shards, 5)
    level, bucket = np.nonzero(counts)
    st.put_table(store, "prefixes", str(pid), pa.table({"level": level, "bucket": bucket, "n": counts[level, bucket]}))


def _candidates(x: _Chunk, chunk: int, answers: ex.Answers, window: int, n_shards: int, heavy: np.ndarray):
    """Suffixes with a repeated anchor: their window classes and the leaves to send, in shard order."""
    seen = answers.aligned(chunk, x.keys, n_shards, np.uint8) > 1
    at = x.start[seen[np.searchsorted(x.anchors, x.anchor_of)]]
    k1, k2 = x.windows(at, window)
    return at, k1, k2


def _route(x: _Chunk, at: np.ndarray, k1: np.ndarray, window: int, heavy: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of the group of each suffix: its shortest prefix that is not heavy."""
    group, open_ = k1.copy(), np.ones(len(at), bool)
    for i, n in enumerate(LEVELS):
        if n < window and open_.any():
            which = np.flatnonzero(open_)
            p = _prefix_at(x.h, at[which], n)
            light = ~heavy[i][_bucket(p)]
            group[which[light]] = mix(p[light] + U64(n))
            open_[which[light]] = False
    return ((group >> U64(20)) % U64(n_shards)).astype(np.int64)


def _prefix_at(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """grams(h, n, salt=n) at chosen positions."""
    m = U64((0xC2B2AE3D27D4EB4F + 2 * n * 0x165667B19E3779F9) & (2**64 - 1) | 1)
    acc = np.full(len(at), U64(n + n * 1000003 + 1), U64)
    for j in range(n):
        acc *= m
        acc += h[at + j]
    return mix(acc)


def _leaves(x: _Chunk, cols: dict, at, k1, k2, window, heavy, n_shards):
    """(earliest suffix of each window class, class of every suffix, shard order and bounds of the classes)."""
    doc = np.array([_LAST if d is None else d for d in cols["doc_id"]], np.int64)
    owner = np.searchsorted(x.off, at, side="right") - 1
    order = np.lexsort((at, doc[owner], k2, k1))
    new = np.concatenate([[True], (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])])
    cls = np.empty(len(at), np.int64)
    cls[order] = np.cumsum(new) - 1
    lead = order[new]
    shard = _route(x, at[lead], k1[lead], window, heavy, n_shards)
    by, bounds = ex.by_shard(shard, n_shards)
    return lead, cls, by, bounds, doc[owner]


def _send_leaves(batches, window: int, seed: int, n_shards: int, store: str, heavy: np.ndarray
                 ) -> Iterator[pa.RecordBatch]:
    pid = ex.pid()
    answers = ex.Answers(store, "anchors", pid)
    for c, cols in enumerate(chunks(batches, "text", CHUNK)):
        x = _Chunk(cols, window, seed)
        if not len(x.start):
            continue
        at, k1, k2 = _candidates(x, c, answers, window, n_shards, heavy)
        if not len(at):
            continue
        lead, _, by, bounds, doc = _leaves(x, cols, at, k1, k2, window, heavy, n_shards)
        pick = lead[by]
        e = np.empty(len(pick), _ENTRY)
        e["k1"], e["k2"], e["doc"], e["pos"] = k1[pick], k2[pick], doc[pick], at[pick]
        full = [s for s in range(n_shards) if bounds[s + 1] > bounds[s]]
        yield ex.rows(full, pid, c, [e[bounds[s]:bounds[s + 1]].tobytes() for s in full])


def _subtrees(blocks: list[bytes]) -> list[bytes]:
    """For every leaf of a shard: 1 if an equal window starts earlier.  Blocks come in file order."""
    sizes = [len(b) // _ENTRY.itemsize for b in blocks]
    e = np.frombuffer(b"".join(blocks), _ENTRY)
    block = np.repeat(np.arange(len(blocks), dtype=np.int32), sizes)
    order = np.lexsort((e["pos"], block, e["doc"], e["k2"], e["k1"]))
    k1, k2 = e["k1"][order], e["k2"][order]
    same = np.concatenate([[False], (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])]) if len(e) else np.zeros(0, bool)
    out = np.empty(len(e), np.uint8)
    out[order] = same
    return [x.tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]


def _cut(batches, window: int, seed: int, n_shards: int, store: str, heavy: np.ndarray, text_out: bool
         ) -> Iterator[pa.RecordBatch]:
    """Last pass: remove the words that repeats cover."""
    pid = ex.pid()
    anchors, nodes = ex.Answers(store, "anchors", pid), ex.Answers(store, "nodes", pid)
    for c, cols in enumerate(chunks(batches, "text", CHUNK)):
        x = _Chunk(cols, window, seed)
        gone = np.zeros(int(x.off[-1]), bool)
        if len(x.start):
            at, k1, k2 = _candidates(x, c, anchors, window, n_shards, heavy)
            if len(at):
                lead, cls, by, bounds, _ = _leaves(x, cols, at, k1, k2, window, heavy, n_shards)
                parts = nodes.parts.pop(c, {})
                flat = np.frombuffer(b"".join(parts[s] for s in sorted(parts)), np.uint8)
                if len(flat) != len(lead):
                    raise RuntimeError("the input changed between two passes")
                earlier = np.empty(len(lead), bool)
                earlier[by] = flat > 0
                repeat = earlier[cls]
                repeat |= lead[cls] != np.arange(len(at))
                hit = at[repeat]
                step = np.bincount(hit, minlength=len(gone) + 1) - np.bincount(hit + window, minlength=len(gone) + 1)
                gone = np.cumsum(step)[:-1] > 0
        removed = np.zeros(len(x.texts), np.int64)
        for i in np.flatnonzero(np.diff(x.off)):
            removed[i] = np.count_nonzero(gone[x.off[i]:x.off[i + 1]])
        sha, kept = [], []
        for i, t in enumerate(x.texts):
            words = t.split()
            if removed[i]:
                words = compress(words, (~gone[x.off[i]:x.off[i + 1]]).tolist())
            text = b" ".join(words)
            sha.append(hashlib.sha256(text).hexdigest())
            if text_out:
                kept.append(text.decode("utf-8", "replace"))
        out = {"doc_id": pa.array(cols["doc_id"], pa.int64()), "n_words": pa.array(np.diff(x.off)),
               "n_removed": pa.array(removed), "kept_sha256": pa.array(sha)}
        if text_out:
            out["kept"] = pa.array(kept, pa.string())
        yield pa.RecordBatch.from_pydict(out)


def remove_repeats(docs: DataFrame, window: int = 20, seed: int = 5, group_share: float = 0.25,
                   text_out: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id bigint, text string): doc_id, n_words, n_removed, kept_sha256 (and kept).

    A prefix is split further while its bucket holds more than ``group_share``
    of a shard's even share of all suffixes.
    """
    if not 1 <= seed <= window:
        raise ValueError("1 <= seed <= window")
    spark = docs.sparkSession
    store = st.new_store(spark, "substrings")
    src = st.scanned(docs, store).select("doc_id", F.col("text").cast("binary").alias("text"))
    n_pids, n_shards = max(1, src.rdd.getNumPartitions()), st.shards_of(src)
    args = {"window": window, "seed": seed, "n_shards": n_shards, "store": store}
    anchors = src.mapInArrow(partial(_sparse_pass, **args), ex.BLOCK_SCHEMA)
    ex.answered(anchors, ex.count_answer(5), n_shards, n_pids, store, "anchors")
    # at most len(LEVELS) * BUCKETS rows, whatever the input
    counts = st.read_table(spark, store, "prefixes", "level long, bucket long, n long").groupBy("level", "bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros((len(LEVELS), BUCKETS), np.int64)
    for r in counts:
        total[r["level"], r["bucket"]] = r["n"]
    heavy = total > group_share * max(1, total[0].sum()) / n_shards
    leaves = src.mapInArrow(partial(_send_leaves, heavy=heavy, **args), ex.BLOCK_SCHEMA)
    ex.answered(leaves, _subtrees, n_shards, n_pids, store, "nodes")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if text_out else "")
    return src.mapInArrow(partial(_cut, heavy=heavy, text_out=text_out, **args), schema)
