"""Benchmark decontamination by winnowing (operator 2).

Words are maximal runs of ASCII letters, digits and non-ASCII characters, in
lower case (A-Z only).  A window is ``span`` consecutive words of an item; an
item with fewer words, but not none, is one window.

*Winnowing.*  In every run of w = n - k + 1 consecutive k-grams the smallest
hash (the rightmost, if equal) is a fingerprint.  Two texts that share n words
choose the same fingerprint inside them, so every shared window is found.  One
pair (k, w) is used for each window length n in the benchmark: normally only
n = ``span``; shorter items add their own lengths.

*Join.*  The fingerprints of the documents meet those of the benchmark.  While
the benchmark's fingerprints and windows number at most ``broadcast_max`` (32
bytes each; counted first), they go to every task as sorted arrays and documents
are never shuffled.  Beyond that the documents' fingerprints, and then the
windows around those that were found, are joined by shuffles, with the same
result.

*Extension.*  Around each found fingerprint, the windows that contain it are
looked up by 128-bit key; each occurrence marks its words as hit.

A document is contaminated if words are hit and they are at least
1 / ``share`` of its words.  Null texts have no words.  Repeated documents are
reported each; null item_ids are items like others, listed as an empty string;
equal item_ids are one item.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.textvec import ALNUM_WORDS, U64, chunks, grams, mix, sliding_min, whole, words_of

CHUNK = 8 << 20
SLICE = 1 << 23
K = 5
OUT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, ref long")


def window_keys(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return grams(h, n, salt=11), grams(h, n, salt=22)


def fingerprints(h: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, position) of the fingerprints for windows of n words."""
    if len(h) > SLICE:  # a long text: slices that share n - 1 words hold every window once
        parts = []
        for a in range(0, len(h), SLICE):
            b = min(len(h), a + SLICE + n - 1)
            value, pos = _fingerprints(h[a:b], np.clip(off, a, b) - a, n)
            parts.append((value, pos + a))
        value, pos = (np.concatenate(x) for x in zip(*parts))
        pos, first = np.unique(pos, return_index=True)
        return value[first], pos
    return _fingerprints(h, off, n)


def _fingerprints(h: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    k = min(K, n)
    start = np.flatnonzero(whole(off, n))
    g = grams(h, k, salt=n)
    if not len(start):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    # the value in the high bits, the position (inverted: the rightmost wins) in the low ones
    low = (g & ~U64(0xFFFFFF)) | (U64(0xFFFFFF) - (np.arange(len(g), dtype=U64) & U64(0xFFFFFF)))
    best = np.unique(sliding_min(low, n - k + 1)[start])
    slot = (U64(0xFFFFFF) - (best & U64(0xFFFFFF))).astype(np.int64)
    # a slice is below 2**24 words, so the slot is the position
    return mix((best >> U64(24)) + (U64(n) << U64(48))), slot


def around(pos: np.ndarray, off: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of n words that contain the k-grams at ``pos`` and lie in their document."""
    k = min(K, n)
    doc = np.searchsorted(off, pos, side="right") - 1
    start = (pos[:, None] - np.arange(n - k + 1)).ravel()
    d = np.repeat(doc, n - k + 1)
    return np.unique(start[(start >= off[d]) & (start + n <= off[d + 1])])


class Benchmark:
    """Fingerprints and windows of the items, as sorted arrays."""

    def __init__(self, lengths, prints, key, key2, item_off, items):
        self.lengths, self.prints = lengths, prints
        self.key, self.key2, self.item_off, self.items = key, key2, item_off, items

    def find(self, h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, window number) of all occurrences of windows in a batch of documents."""
        starts, sizes, which = [], [], []
        for n in self.lengths:
            value, pos = fingerprints(h, off, n)
            at = np.minimum(np.searchsorted(self.prints, value), len(self.prints) - 1)
            s = around(pos[self.prints[at] == value], off, n)
            a, b = _keys_at(h, s, n, 11), _keys_at(h, s, n, 22)
            w = np.minimum(np.searchsorted(self.key, a), len(self.key) - 1)
            ok = (self.key[w] == a) & (self.key2[w] == b)
            starts.append(s[ok])
            sizes.append(np.full(int(ok.sum()), n))
            which.append(w[ok])
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(which)


def _keys_at(h: np.ndarray, at: np.ndarray, k: int, salt: int) -> np.ndarray:
    """grams(h, k, salt) at chosen positions."""
    m = U64((0xC2B2AE3D27D4EB4F + 2 * salt * 0x165667B19E3779F9) & (2**64 - 1) | 1)
    acc = np.full(len(at), U64(k + salt * 1000003 + 1), U64)
    for j in range(k):
        acc *= m
        acc += h[at + j]
    return mix(acc)


def _items(batches, span: int) -> Iterator[pa.RecordBatch]:
    """Windows and fingerprints of the items: (kind 0 print / 1 window, key, key2, length, item)."""
    for cols in chunks(batches, "text", CHUNK):
        h, off = words_of([t or b"" for t in cols["text"]], True, ALNUM_WORDS)
        size = np.diff(off)
        for n in np.unique(np.minimum(size, span)).tolist():
            if not n:
                continue
            mine = np.flatnonzero(np.minimum(size, span) == n)
            words = np.concatenate([h[off[i]:off[i + 1]] for i in mine])
            own = np.concatenate([[0], np.cumsum(size[mine])])
            value, _ = fingerprints(words, own, n)
            start = np.flatnonzero(whole(own, n))
            a, b = (x[start] for x in window_keys(words, n))
            item = ["" if cols["item_id"][i] is None else str(cols["item_id"][i]) for i in mine]
            owner = np.searchsorted(own, start, side="right") - 1
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(np.concatenate([np.zeros(len(value)), np.ones(len(a))]).astype(np.int32)),
                "key": pa.array(np.concatenate([value, a]).view(np.int64)),
                "key2": pa.array(np.concatenate([np.zeros(len(value), U64), b]).view(np.int64)),
                "n": pa.array(np.full(len(value) + len(a), n, np.int32)),
                "item": pa.array([""] * len(value) + [item[i] for i in owner], pa.string())})


def _collected(rows: DataFrame, lengths: list[int]) -> Benchmark:
    t = rows.toArrow()
    kind, key, key2 = (t.column(i).to_numpy() for i in range(3))
    w = kind == 1
    prints = np.unique(key[~w].view(U64))
    a, b, items = key[w].view(U64), key2[w].view(U64), np.array(t.column(4).to_pylist(), object)[w]
    order = np.lexsort((b, a))
    a, b, items = a[order], b[order], items[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return Benchmark(lengths, prints, a[first], b[first], np.append(first, len(a)), items)


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _mark(batches, bench: Benchmark, share: int) -> Iterator[pa.RecordBatch]:
    pid, base = ex.pid(), 0
    for cols in chunks(batches, "text", CHUNK):
        h, off = words_of([t or b"" for t in cols["text"]], True, ALNUM_WORDS)
        start, size, which = bench.find(h, off)
        hit = np.cumsum(np.bincount(start, minlength=len(h) + 1) - np.bincount(start + size, minlength=len(h) + 1))[:-1] > 0
        run = np.concatenate([[0], np.cumsum(hit)])
        n_words = np.diff(off)
        n_hit = run[off[1:]] - run[off[:-1]]
        found: list[set[str]] = [set() for _ in n_words]
        doc = np.searchsorted(off, start, side="right") - 1
        for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
            found[d].update(bench.items[bench.item_off[w]:bench.item_off[w + 1]])
        yield _result(cols["doc_id"], n_words, n_hit, [len(x) for x in found], [_digest(x) for x in found], share,
                      (pid << ex.REF_BITS) + base + np.arange(len(n_words)))
        base += len(n_words)


def _result(doc_id, n_words, n_hit, n_items, sha, share, ref) -> pa.RecordBatch:
    n_words, n_hit = np.asarray(n_words, np.int64), np.asarray(n_hit, np.int64)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(doc_id, pa.int64()), "n_words": pa.array(n_words), "n_hit": pa.array(n_hit),
        "n_items": pa.array(np.asarray(n_items, np.int64)), "items_sha256": pa.array(sha, pa.string()),
        "contaminated": pa.array((n_hit > 0) & (share * n_hit >= n_words)), "ref": pa.array(ref)})


def _doc_prints(batches, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    pid, base = ex.pid(), 0
    for cols in chunks(batches, "text", CHUNK):
        h, off = words_of([t or b"" for t in cols["text"]], True, ALNUM_WORDS)
        for n in lengths:
            value, pos = fingerprints(h, off, n)
            doc = np.searchsorted(off, pos, side="right") - 1
            yield pa.RecordBatch.from_pydict({"key": value.view(np.int64), "n": np.full(len(pos), n, np.int32),
                                              "ref": (pid << ex.REF_BITS) + base + doc, "pos": pos - off[doc]})
        base += len(off) - 1


def _doc_windows(batches, store: str) -> Iterator[pa.RecordBatch]:
    """Keys of the windows around the found fingerprints, which a side file lists."""
    pid, base = ex.pid(), 0
    data = st.get(store, f"found/{pid}")
    found = np.frombuffer(data, np.int64).reshape(-1, 3) if data else np.zeros((0, 3), np.int64)
    for cols in chunks(batches, "text", CHUNK):
        h, off = words_of([t or b"" for t in cols["text"]], True, ALNUM_WORDS)
        lo, hi = np.searchsorted(found[:, 0], [base, base + len(off) - 1])
        mine = found[lo:hi]
        for n in np.unique(mine[:, 1]).tolist():
            f = mine[mine[:, 1] == n]
            s = around(off[f[:, 0] - base] + f[:, 2], off, n)
            doc = np.searchsorted(off, s, side="right") - 1
            yield pa.RecordBatch.from_pydict({
                "key": _keys_at(h, s, n, 11).view(np.int64), "key2": _keys_at(h, s, n, 22).view(np.int64),
                "n": np.full(len(s), n, np.int32), "ref": (pid << ex.REF_BITS) + base + doc, "pos": s - off[doc]})
        base += len(off) - 1


def _put_found(batches, store: str) -> Iterator[pa.RecordBatch]:
    cols = [np.concatenate(x) for x in zip(*([b.column(i).to_numpy() for i in range(4)] for b in batches))]
    if cols:
        pid_, row, n, pos = cols
        for p in np.unique(pid_):
            at = np.flatnonzero(pid_ == p)
            at = at[np.lexsort((pos[at], n[at], row[at]))]
            st.put(store, f"found/{p}", np.stack([row[at], n[at], pos[at]], 1).astype(np.int64).tobytes())
    yield pa.RecordBatch.from_pydict({"n": np.array([len(cols)], np.int64)})


def _counts(batches) -> Iterator[pa.RecordBatch]:
    pid, base = ex.pid(), 0
    for cols in chunks(batches, "text", CHUNK):
        _, off = words_of([t or b"" for t in cols["text"]], True, ALNUM_WORDS)
        n = len(off) - 1
        yield pa.RecordBatch.from_pydict({"ref": (pid << ex.REF_BITS) + base + np.arange(n),
                                          "doc_id": pa.array(cols["doc_id"], pa.int64()), "n_words": np.diff(off)})
        base += n


def find_contamination(docs: DataFrame, benchmark: DataFrame, span: int = 13, share: int = 20,
                       broadcast_max: int = 4_000_000) -> tuple[DataFrame, DataFrame, str]:
    """(result, plain scan of ``docs``, store).

    Result per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256
    (of the sorted, comma-joined item ids found), contaminated, ref.
    """
    spark = docs.sparkSession
    store = st.new_store(spark, "decontam")
    scan = st.scanned(docs, store)
    src = scan.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = st.saved(benchmark.select("item_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        partial(_items, span=span), "kind int, key long, key2 long, n int, item string").distinct(), store, "items")
    lengths = sorted(r[0] for r in rows.select("n").distinct().collect())  # at most `span` values
    if rows.limit(broadcast_max + 1).count() <= broadcast_max:
        if not lengths:
            bench = Benchmark([], *(np.zeros(1, U64) for _ in range(3)), np.zeros(2, np.int64), np.zeros(0, object))
            bench.find = None
            return src.mapInArrow(partial(_no_items, share=share), OUT), scan, store
        return src.mapInArrow(partial(_mark, bench=_collected(rows, lengths), share=share), OUT), scan, store
    return _by_shuffle(src, rows, lengths, share, store), scan, store


def _no_items(batches, share: int) -> Iterator[pa.RecordBatch]:
    """An empty benchmark hits nothing."""
    for b in _counts(batches):
        n = b.num_rows
        yield _result(b.column(1), b.column(2).to_numpy(), np.zeros(n), np.zeros(n), [_digest(set())] * n, share, b.column(0))


def _by_shuffle(src: DataFrame, rows: DataFrame, lengths: list[int], share: int, store: str) -> DataFrame:
    """The joins as shuffles, for a benchmark that is too large for every task."""
    n_pids = max(1, src.rdd.getNumPartitions())
    prints = src.mapInArrow(partial(_doc_prints, lengths=lengths), "key long, n int, ref long, pos long")
    found = prints.join(rows.where("kind = 0").select("key", "n").distinct(), ["key", "n"], "left_semi")
    (found.select(F.shiftright("ref", ex.REF_BITS).cast("int").alias("pid"),
                  F.col("ref").bitwiseAND(F.lit((1 << ex.REF_BITS) - 1)).alias("row"), F.col("n").cast("long").alias("n"), "pos")
     .repartitionById(n_pids, "pid").mapInArrow(partial(_put_found, store=store), "n long").agg({"n": "sum"}).collect())
    windows = src.mapInArrow(partial(_doc_windows, store=store), "key long, key2 long, n int, ref long, pos long")
    hits = st.saved(windows.join(rows.where("kind = 1").select("key", "key2", "n", "item"), ["key", "key2", "n"])
                    .select("ref", "pos", "n", "item"), store, "hits")
    # words hit: the union of the intervals [pos, pos + n), each counted from where the ones before it end
    spans = hits.groupBy("ref", "pos").agg(F.max("n").alias("n")).groupBy("ref").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col("n").cast("long").alias("n")))).alias("s"))
    words = spans.select("ref", F.aggregate(
        "s", F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["pos"] + x["n"]).alias("end"),
            (acc["sum"] + F.greatest(F.lit(0).cast("long"), x["pos"] + x["n"] - F.greatest(acc["end"], x["pos"]))).alias("sum")),
        lambda acc: acc["sum"]).alias("n_hit"))
    items = hits.groupBy("ref").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = (src.mapInArrow(_counts, "ref long, doc_id long, n_words long").join(words, "ref", "left").join(items, "ref", "left")
           .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
           .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"), "ref")
