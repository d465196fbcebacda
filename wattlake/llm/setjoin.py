"""N-gram Jaccard join by universe partition and the pigeonhole principle (operator 7).

A document's set holds the hashes of its distinct ``k``-word shingles.  Two
sets with Jaccard similarity >= num/den differ in at most
``H = (a + b) * (den - num) // (den + num)`` elements.

*Size bands.*  Bands are cut so that a partner is in the same or the next
band.  Band b splits the hash universe into ``m_b`` segments.  A document
indexes the subset that falls in each segment, under its own band's
segmentation and under that of the band above.

*Pigeonhole with cost-based allocation.*  Give segment i a budget e_i (0: not
looked at, 1: equal subsets, 2: subsets that differ in at most one element)
with sum(e) >= H + 1; a partner must then match in one of the segments.
Budgets go to the segments whose subsets are rarest in the whole corpus, so
subsets made of common passages are not looked at.  A document with H + 1
subsets that occur nowhere else has no partner and is out, which removes most
documents before any pair is made.  Where a set has too few non-empty segments
for budgets of 1, its rarest segments get 2, and the documents of that band
also index the one-deletion neighbourhood of their subsets.  Where even that is
too little (a tiny set whose elements share segments), the band's key itself
is indexed, so that nothing is lost.

*Links.*  Candidates are verified exactly on the sets, which stay in
memory-mapped side files.  Copies (equal sets) are represented by one document.
Within the group of one subset, documents are first compared with three
centres; what that connects needs no further comparison.  What is left is
searched through memory-mapped posting lists: of two documents in different
components the one with fewer probes reads the lists of its probes and compares
itself with their members.  No linked pair of different components is missed,
no pairs become rows, and a large group of near copies costs a few comparisons
per member.

Nulls and short texts: a text without words has an empty set, no links and is
its own component; one of fewer than k words has one shingle, its whole word
sequence.  Repeated doc_ids are separate rows; a null doc_id is ignored in the
minimum.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.components import components
from wattlake.llm.textvec import U64, chunks, grams, mix, whole, words_of

CHUNK = 2 << 20
WIDTH = 5
REF_BITS = ex.REF_BITS
#: Texts that are sorted together (under 2**10), and the bits left for a shingle's hash.
GROUP, HASH_BITS = 1000, 54


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the sorted distinct shingle hashes (HASH_BITS wide) of each text."""
    vals, offs, base = [], [np.zeros(1, np.int64)], 0
    for i in range(0, len(texts), GROUP):
        h, off = words_of(texts[i:i + GROUP], lower=True)
        n = len(off) - 1
        g, ok = grams(h, k), whole(off, k)
        size = np.diff(off)
        doc = np.repeat(np.arange(n, dtype=U64), size)
        parts = [(doc[:len(g)][ok] << U64(HASH_BITS)) | (g[ok] >> U64(64 - HASH_BITS))]
        for w in range(1, k):  # shorter texts: the whole sequence
            short = np.flatnonzero(size == w)
            if len(short):
                acc = np.full(len(short), U64(w), U64)
                for j in range(w):
                    acc = mix(acc + h[off[short] + j])
                parts.append((short.astype(U64) << U64(HASH_BITS)) | (acc >> U64(64 - HASH_BITS)))
        v = np.sort(np.concatenate(parts))  # by document, then by value
        if len(v):
            v = v[np.concatenate([[True], v[1:] != v[:-1]])]
        offs.append(base + np.searchsorted(v, np.arange(1, n + 1).astype(U64) << U64(HASH_BITS)))
        base += len(v)
        vals.append(v & U64((1 << HASH_BITS) - 1))
    return np.concatenate(vals) if vals else np.zeros(0, U64), np.concatenate(offs).astype(np.int64)


class Bands:
    """Size bands: the partners of a set in band b have their size in b - 1 .. b + 1."""

    def __init__(self, num: int, den: int, density: float):
        self.num, self.den = num, den
        lo = [1]
        while lo[-1] < 1 << 40:
            lo.append(lo[-1] * den // num + 1)
        self.lo = np.array(lo, np.int64)
        hi = self.lo[1:] - 1
        # small bands get more segments, so that elements seldom share one
        self.m = np.maximum(np.ceil(density * hi).astype(np.int64), np.minimum(64, 6 * hi))
        self.m = np.maximum(self.m, self.diff(hi, hi) + 1)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lo, size, side="right") - 1

    def diff(self, a, b):
        """Largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def budget(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        """H + 1 for the largest partner that a set can have in a band's segmentation."""
        largest = np.minimum(self.lo[band + 1] - 1, size * self.den // self.num)
        return self.diff(size, largest) + 1


def _segment_key(total: np.ndarray, band: np.ndarray, seg: np.ndarray) -> np.ndarray:
    return mix(total + (band.astype(U64) << U64(32)) + seg * U64(0xD6E8FEB86659FD93))


def segments(v: np.ndarray, off: np.ndarray, bands: Bands):
    """The non-empty segments of each set, under its own band's cut and the one above.

    Returns (key, doc, up, size, parts): key of the subset, owner, 1 for the
    cut of the band above, elements.  A segment is a range of hash values, so
    the sorted sets are already in segment order.
    """
    size = np.diff(off)
    own = bands.of(np.maximum(size, 1))
    doc = np.repeat(np.arange(len(size), dtype=np.int64), size)
    mixed = mix(v)
    keys, docs, ups, sizes, parts = [], [], [], [], []
    for up in (0, 1):
        band = own + up
        seg = (v >> U64(HASH_BITS - 32)) * bands.m[band].astype(U64)[doc] >> U64(32)
        if len(v):
            first = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (doc[1:] != doc[:-1])]))
            total = np.add.reduceat(mixed, first)
            keys.append(_segment_key(total, band[doc[first]], seg[first]))
            docs.append(doc[first])
            ups.append(np.full(len(first), up, np.int8))
            sizes.append(np.diff(np.append(first, len(v))))
            parts.append((first, total, band[doc[first]], seg[first]))
    if not keys:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z, z.astype(np.int8), z, []
    return np.concatenate(keys), np.concatenate(docs), np.concatenate(ups), np.concatenate(sizes), parts


def deletions(v: np.ndarray, parts: list, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-deletion neighbourhood of the wanted segments: (key, index of the segment)."""
    keys, which, base = [], [], 0
    for first, total, band, seg in parts:
        n = len(first)
        seg_of = np.repeat(np.arange(n), np.diff(np.append(first, len(v))))
        pick = wanted[base:base + n][seg_of]
        at = seg_of[pick]
        keys.append(_segment_key(total[at] - mix(v[pick]), band[at], seg[at]))
        which.append(base + at)
        base += n
    return np.concatenate(keys), np.concatenate(which)


def _needs(off: np.ndarray, doc, up, seg_size, bands: Bands):
    """Per set and cut: budget wanted, non-empty segments, capacity; own band."""
    n, size = len(off) - 1, np.diff(off)
    own = bands.of(np.maximum(size, 1))
    # partners above: only if the band above holds sizes that a link allows
    reach = size * bands.den // bands.num >= bands.lo[own + 1]
    need = np.stack([bands.budget(size, own), np.where(reach, bands.budget(size, own + 1), 0)], 1)
    need[size == 0] = 0
    group = doc * 2 + up
    have = np.bincount(group, minlength=2 * n).reshape(n, 2)
    # a budget of 2 goes to segments of two and more elements: the partner's is then not empty
    room = have + np.bincount(group[seg_size > 1], minlength=2 * n).reshape(n, 2)
    return need, have, room, own


def _emit_segments(batches, k: int, bands: Bands, n_shards: int, store: str) -> Iterator[pa.RecordBatch]:
    """First pass: blocks of segment keys; the sizes and set hashes go to a side table."""
    pid, base, meta = ex.pid(), 0, []
    for c, cols in enumerate(chunks(batches, "text", CHUNK)):
        v, off = shingle_sets([t or b"" for t in cols["text"]], k)
        n = len(off) - 1
        size = np.diff(off)
        full = size > 0
        h = np.zeros((2, n), U64)
        if len(v):
            for i, salt in enumerate((U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))):
                h[i, full] = np.add.reduceat(mix(v * salt), off[:-1][full])
        keys, doc, up, seg_size, _ = segments(v, off, bands)
        need, have, _, own = _needs(off, doc, up, seg_size, bands)
        lack = np.where(have < need, own[:, None] + np.arange(2), -1)
        meta.append(pa.table({"ref": np.arange(n) + base + (pid << REF_BITS),
                              "doc_id": pa.array(cols["doc_id"], pa.int64()), "n_shingles": size.astype(np.int64),
                              "h1": h[0].view(np.int64), "h2": h[1].view(np.int64),
                              "lack0": lack[:, 0].astype(np.int64), "lack1": lack[:, 1].astype(np.int64)}))
        base += n
        if len(keys):
            yield ex.key_blocks(keys, pid, c, n_shards, WIDTH)
    if meta:
        st.put_table(store, "meta", str(pid), pa.concat_tables(meta))


def _allocate(off, key, doc, up, seg_size, seen, bands: Bands, alive: np.ndarray):
    """Budgets by cost: (probe and double flags of the segments, sets short of budget, sets left, own bands)."""
    n = len(off) - 1
    need, have, room, own = _needs(off, doc, up, seg_size, bands)
    need = np.where(alive[:, None], need, 0)
    group = doc * 2 + up
    unique = np.bincount(group[seen <= 1], minlength=2 * n).reshape(n, 2)
    opened = unique < need
    lacking = (opened & (have < need)).ravel()
    probe, double = np.zeros(len(key), bool), np.zeros(len(key), bool)
    at = np.flatnonzero(opened.ravel()[group])
    g = group[at]

    def rank(order: np.ndarray) -> np.ndarray:
        s = g[order]
        return np.arange(len(s)) - np.searchsorted(s, s)

    order = np.lexsort((key[at], seen[at], g))  # rarest first; the first `need` of a cut are looked at
    probe[at[order]] = rank(order) < need.ravel()[g[order]]
    if lacking.any():
        order = np.lexsort((key[at], seen[at], seg_size[at] < 2, g))
        r, s = rank(order), g[order]
        double[at[order]] = lacking[s] & (r < (need - have).ravel()[s]) & (seg_size[at[order]] > 1)
    return probe, double, opened & (room < need), opened.any(1) & alive, own


def _emit_candidates(batches, k: int, bands: Bands, n_shards: int, store: str, weak: tuple[int, ...]
                     ) -> Iterator[pa.RecordBatch]:
    """Second pass: index and probe rows of the sets that may have a partner; the sets go to side files."""
    pid, base = ex.pid(), 0
    answers = ex.Answers(store, "seen", pid)
    data = st.get(store, f"reps/{pid}")
    reps = np.frombuffer(data, np.int64) if data else np.zeros(0, np.int64)
    kept_ord, kept_len, kept_val = [], [], []
    for c, cols in enumerate(chunks(batches, "text", CHUNK)):
        v, off = shingle_sets([t or b"" for t in cols["text"]], k)
        n = len(off) - 1
        alive = np.zeros(n, bool)
        alive[reps[(reps >= base) & (reps < base + n)] - base] = True
        key, doc, up, seg_size, parts = segments(v, off, bands)
        if len(key):
            seen = answers.aligned(c, key, n_shards, np.uint8)
            probe, double, short, left, own = _allocate(off, key, doc, up, seg_size, seen, bands, alive)
            out_key, out_doc, out_probe = _rows_of(v, key, doc, up, parts, seen, probe, double, short, left, own, weak)
            ref = out_doc + base + (pid << REF_BITS)
            size = np.diff(off)[out_doc].astype(np.int32)
            for i in range(0, len(ref), 1 << 18):
                j = slice(i, i + (1 << 18))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_key[j].view(np.int64)), pa.array(ref[j]), pa.array(size[j]),
                     pa.array(out_probe[j])], names=["sig", "ref", "size", "probe"])
            which = np.flatnonzero(left)
            kept_ord.append(which + base)
            kept_len.append(np.diff(off)[which])
            kept_val.append(v[np.repeat(left, np.diff(off))])
        base += n
    cat = lambda a, t: np.concatenate(a) if a else np.zeros(0, t)
    lens = cat(kept_len, np.int64)
    st.put_arrays(store, f"sets/{pid}", ord=cat(kept_ord, np.int64).astype(np.int64),
                  off=np.concatenate([[0], np.cumsum(lens)]).astype(np.int64), val=cat(kept_val, U64))


def _rows_of(v, key, doc, up, parts, seen, probe, double, short, left, own, weak):
    """(key, doc, probe) rows of the sets left."""
    use = left[doc] & (seen > 1)
    in_weak = np.isin(own[doc] + up, weak) & left[doc]
    keys, docs, probes = [key[use]], [doc[use]], [probe[use] | double[use]]
    if in_weak.any():
        # In a weak band every whole subset and its deletions are indexed; a budget of 2 probes with both.
        plain = in_weak & ~use
        dk, dw = deletions(v, parts, in_weak)
        keys += [key[plain], dk]
        docs += [doc[plain], doc[dw]]
        probes += [double[plain], double[dw]]
        for u in (0, 1):  # sets whose budgets cannot reach H + 1: everything in the band
            members = np.flatnonzero(left & np.isin(own + u, weak))
            keys.append(mix((own[members] + u).astype(U64) + U64(0x51ED270B)))
            docs.append(members)
            probes.append(short[members, u])
    return np.concatenate(keys), np.concatenate(docs), np.concatenate(probes)


class _Sets:
    """Random access to the sets in the side files."""

    def __init__(self, store: str):
        self.store, self.held = store, {}

    def get(self, ref: int) -> np.ndarray:
        p = ref >> REF_BITS
        if p not in self.held:
            if len(self.held) > 256:
                self.held.pop(next(iter(self.held)))
            o, off, val = (st.map_array(self.store, f"sets/{p}", x) for x in ("ord", "off", "val"))
            self.held[p] = np.asarray(o), np.asarray(off), val
        o, off, val = self.held[p]
        i = int(np.searchsorted(o, ref & ((1 << REF_BITS) - 1)))
        return np.asarray(val[off[i]:off[i + 1]])

    def linked(self, one: np.ndarray, refs: np.ndarray, num: int, den: int) -> np.ndarray:
        """Which of the sets ``refs`` are linked with the set ``one``?"""
        out = np.zeros(len(refs), bool)
        for i in range(0, len(refs), 1024):
            many = [self.get(int(r)) for r in refs[i:i + 1024]]
            size = np.fromiter(map(len, many), np.int64, len(many))
            flat = np.concatenate(many)
            at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
            both = np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum(size) - size)
            out[i:i + 1024] = den * both >= num * (len(one) + size - both)
        return out


def _verify(batches, store: str, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (a, b) whose sets are linked."""
    sets = _Sets(store)
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        ok = np.zeros(len(a), bool)
        cuts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(a)]):
            ok[lo:hi] = sets.linked(sets.get(int(a[lo])), b[lo:hi], num, den)
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])


_POST = ("sig", "ref", "component", "size", "probes")


def _write_postings(batches, store: str) -> Iterator[pa.RecordBatch]:
    """One shard's posting lists as sorted arrays."""
    got = [[b.column(i).to_numpy() for i in range(6)] for b in batches if b.num_rows]
    if got:
        cols = [np.concatenate(x) for x in zip(*got)]
        order = np.lexsort((cols[2], cols[1]))
        shard = cols[0][order]
        for s in np.unique(shard):
            at = order[shard == s]
            st.put_arrays(store, f"post/{s}", **{n: cols[i + 1][at] for i, n in enumerate(_POST)})
    yield pa.RecordBatch.from_arrays([pa.array([len(got)], pa.int64())], names=["n"])


def _search(batches, store: str, n_shards: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Compare each set with the members of its probed posting lists in other components."""
    sets, lists = _Sets(store), {}
    for batch in batches:
        left, right = [], []
        for r in batch.to_pylist():
            parts = []
            for sig in set(r["sigs"]):
                s = sig % n_shards
                if s not in lists:
                    lists[s] = [st.map_array(store, f"post/{s}", n) for n in _POST]
                lo, hi = np.searchsorted(lists[s][0], [sig, sig + 1]) if sig < (1 << 63) - 1 else (
                    int(np.searchsorted(lists[s][0], sig)), len(lists[s][0]))
                parts.append([np.asarray(x[lo:hi]) for x in lists[s][1:]])
            ref, comp, size, probes = (np.concatenate(x) for x in zip(*parts))
            mine = len(r["sigs"])
            # the one with fewer probes searches; either side's probes alone find every partner
            use = ((comp != r["component"]) & (size * num <= r["size"] * den) & (r["size"] * num <= size * den)
                   & ((probes > mine) | ((probes == mine) & (ref > r["ref"]))))
            ref = np.unique(ref[use])
            if len(ref):
                hit = ref[sets.linked(sets.get(r["ref"]), ref, num, den)]
                left += [r["ref"]] * len(hit)
                right.append(hit)
        a, b = np.array(left, np.int64), np.concatenate(right) if right else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def links(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100, density: float = 0.75
          ) -> tuple[DataFrame, DataFrame, str]:
    """(meta, links, store) of ``docs`` (doc_id bigint, text string).

    meta: ref, doc_id, n_shingles, rep (the document that stands for its equal
    sets).  links: verified pairs (a, b) of representatives that connect every
    component; not every linked pair of a component is listed.
    """
    spark = docs.sparkSession
    store = st.new_store(spark, "setjoin")
    src = st.scanned(docs, store).select("doc_id", F.col("text").cast("binary").alias("text"))
    n_pids, n_shards = max(1, src.rdd.getNumPartitions()), st.shards_of(src)
    bands = Bands(num, den, density)
    blocks = src.mapInArrow(partial(_emit_segments, k=k, bands=bands, n_shards=n_shards, store=store),
                            ex.BLOCK_SCHEMA)
    ex.answered(blocks, ex.count_answer(WIDTH), n_shards, n_pids, store, "seen")
    meta = _meta(spark, store)
    _put_reps(meta, n_pids, store)
    # bands: a few dozen at any input size
    weak = tuple(r[0] for r in meta.select(F.explode(F.array("lack0", "lack1")).alias("b")).where("b >= 0")
                 .distinct().collect())
    rows = st.saved(src.mapInArrow(partial(_emit_candidates, k=k, bands=bands, n_shards=n_shards, store=store,
                                           weak=weak), "sig long, ref long, size int, probe boolean"), store, "rows")
    # One shuffle serves the groups and the join back: the groups use every column, so both sides are the same exchange.
    dealt = rows.repartition(n_shards, "sig")
    shared = dealt.groupBy("sig").agg(F.count("*").alias("n"), F.max("probe").alias("p"), F.min("ref").alias("c1"),
                                      F.max("size").alias("m"),
                                      F.min_by("ref", F.xxhash64("ref")).alias("c2"),
                                      F.max_by("ref", F.xxhash64("ref", F.lit(7))).alias("c3")).where("n > 1 and p and m > 0")
    index = st.saved(dealt.join(shared.select("sig", "c1", "c2", "c3"), "sig"), store, "index")
    centres = (index.select(F.explode(F.array("c1", "c2", "c3")).alias("c"), "ref").where("c <> ref")
               .select(F.least("c", "ref").alias("a"), F.greatest("c", "ref").alias("b")).distinct())
    found = st.saved(centres.repartition(n_shards, "a", F.pmod("b", F.lit(16)))
                     .mapInArrow(partial(_verify, store=store, num=num, den=den), "a long, b long"), store, "links1")
    comp = components(found, store, "cc1")
    # what is left: members of one subset's group that are in different components
    named = (index.select("sig", "ref", "size", "probe").join(comp.withColumnRenamed("node", "ref"), "ref", "left")
             .withColumn("component", F.coalesce("component", "ref")))
    mixed = named.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rest = st.saved(named.join(mixed.select("sig"), "sig").dropDuplicates(["sig", "ref", "probe"]), store, "rest")
    seekers = rest.groupBy("ref").agg(F.first("component").alias("component"), F.first("size").alias("size"),
                                      F.collect_list(F.when(F.col("probe"), F.col("sig"))).alias("sigs"))
    seekers = st.saved(seekers, store, "seekers")
    post = (rest.drop("probe").join(seekers.select("ref", F.size("sigs").cast("long").alias("probes")), "ref")
            .select(F.pmod("sig", F.lit(n_shards)).cast("int").alias("shard"), "sig", "ref", "component",
                    F.col("size").cast("long").alias("size"), "probes"))
    post.repartitionById(n_shards, "shard").mapInArrow(partial(_write_postings, store=store), "n long").agg(
        {"n": "sum"}).collect()
    more = st.saved(seekers.where("size(sigs) > 0").repartition(n_shards, "ref").mapInArrow(
        partial(_search, store=store, n_shards=n_shards, num=num, den=den), "a long, b long"), store, "links2")
    return meta, found.union(more), store


def _meta(spark: SparkSession, store: str) -> DataFrame:
    meta = st.read_table(spark, store, "meta", "ref long, doc_id long, n_shingles long, h1 long, h2 long,"
                         " lack0 long, lack1 long")
    rep = (meta.groupBy("n_shingles", "h1", "h2").agg(F.min("ref").alias("rep")).where("n_shingles > 0"))
    return st.saved(meta.join(rep, ["n_shingles", "h1", "h2"], "left")
                    .select("ref", "doc_id", "n_shingles", "lack0", "lack1", F.coalesce("rep", "ref").alias("rep")),
                    store, "meta-rep")


def _put_reps(meta: DataFrame, n_pids: int, store: str) -> None:
    def write(batches) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for b in batches:
            r = b.column(1).to_numpy()
            for p in np.unique(r >> REF_BITS):
                by.setdefault(int(p), []).append(r[r >> REF_BITS == p] & ((1 << REF_BITS) - 1))
        for p, parts in by.items():
            st.put(store, f"reps/{p}", np.sort(np.concatenate(parts)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([len(by)], pa.int64())], names=["n"])

    (meta.where("rep = ref and n_shingles > 0").select(F.shiftright("ref", REF_BITS).cast("int").alias("pid"), "ref")
     .repartitionById(n_pids, "pid").mapInArrow(write, "n long").agg({"n": "sum"}).collect())


def classes(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> tuple[DataFrame, DataFrame, str]:
    """(rows, plain scan of ``docs``, store); rows: ref, doc_id, n_shingles, component (a ref) of every document."""
    scan = st.scanned(docs, st.new_store(docs.sparkSession, "setjoin-input"))
    meta, pairs, store = links(scan, k, num, den)
    comp = components(pairs, store, "cc")
    rows = (meta.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            .select("ref", "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component")))
    return rows, scan, store


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id linked with it), ref."""
    rows, _, _ = classes(docs, k, num, den)
    low = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(low, "component").select("doc_id", "n_shingles", "component_id", "ref")


def keep_one(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of smallest doc_id (null last)."""
    rows, scan, store = classes(docs, k, num, den)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "ref"))
    return ex.with_rows(scan, store, rows.groupBy("component").agg(first.alias("m")).select("m.ref"))
