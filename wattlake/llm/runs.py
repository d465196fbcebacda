"""Periodic runs of words by maximal pairs of an LCP-interval tree (operator 12).

A maximal pair (i, j) with common prefix length l is two occurrences of the same
l words that differ in the word before and in the word after.  If the distance
p = j - i is at most l / 3, the words i .. j + l are a stretch of period p that
no neighbour extends, l + p >= 4 p words long: a run, found whole, nothing is
extended.  Every run of period q with at least 4 q words is such a pair; pairs
at multiples of q have the same ends, so the smallest distance is the period.

Per document:

1. Only nodes of depth ``DEPTH`` = 5 and more can hold a pair (l >= 3 p and
   l + p >= 6), so the suffixes whose first five words occur once in the
   document are left out beforehand; they are leaves above that depth.
2. The other suffixes are sorted by prefix doubling, and the kept ranks give the
   common prefix lengths of neighbours.
3. The intervals are joined bottom-up.  A node lists its positions, and per left
   word the positions that follow it.  The smaller list's positions are looked up
   in the larger node's lists within a third of the depth.  Occurrences that
   close together are a chain whose distances are multiples of the smallest
   period of the node's words, so all but the first of a chain have the same left
   word: one lookup finds the pair with the chain's first, and a first position
   pairs with the class list behind it.  The work is one lookup per position and
   join, plus the pairs.

A run is dropped but for its first period (``collapse``).  Words are compared by
64-bit hashes.  Documents are independent: no shuffle, and a task's memory is
bounded by ``CHUNK`` bytes of text or by its longest document.

Null and empty texts have no words and no runs.  Repeated rows are handled one by
one; null doc_ids are passed on.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import store as st
from wattlake.llm.textvec import U64, chunks, grams, mix, whole, words_of

CHUNK = 6 << 20
DEPTH = 5
#: (doc_id, number of words) -> original word number of every word, or None for the text as it is.
Rewrite = Callable[[int | None, int], "np.ndarray | None"]
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Node:
    """Positions of an LCP interval, in order, and the same by left word."""

    __slots__ = ("at", "after")

    def __init__(self, x: int, word: int):
        self.at, self.after = [x], {word: [x]}

    def add(self, x: int, word: int) -> None:
        insort(self.at, x)
        held = self.after.get(word)
        if held is None:
            self.after[word] = [x]
        else:
            insort(held, x)


def _pairs(node: Node, x: int, word: int, depth: int, left: dict, found: dict) -> None:
    """Maximal pairs of position x with the node's, at most a third of the depth apart."""
    reach, at = depth // 3, node.at
    i = bisect_left(at, x - reach)
    if i == len(at) or at[i] > x + reach:
        return
    first = at[i]
    if first < x:
        if left[first] != word:
            _keep(found, first, x - first, depth)
        i = bisect_right(at, x, i)
    if i < len(at) and at[i] <= x + reach and left[at[i]] != word:
        behind = node.after[left[at[i]]]
        for k in range(bisect_left(behind, x), bisect_right(behind, x + reach)):
            _keep(found, x, behind[k] - x, depth)


def _keep(found: dict, start: int, period: int, depth: int) -> None:
    key = (start, depth + period)
    if period < found.get(key, period + 1):
        found[key] = period


def _joined(a: Node, b: Node, depth: int, left: dict, found: dict) -> Node:
    if len(a.at) < len(b.at):
        a, b = b, a
    for x in b.at:
        _pairs(a, x, left[x], depth, left, found)
    for x in b.at:
        a.add(x, left[x])
    return a


def pairs_bottom_up(at: list[int], common: list[int], left: dict) -> dict[tuple[int, int], int]:
    """(start, length) -> smallest period, from suffixes in order, neighbours' common prefixes and left words."""
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, Node]] = []
    here: Node | None = None
    for x, shared in zip(at, common):  # ``shared`` with the suffix before
        while stack and stack[-1][0] > shared:
            depth, node = stack.pop()
            here = _joined(node, here, depth, left, found)
        if shared >= DEPTH:
            if stack and stack[-1][0] == shared:
                stack[-1] = (shared, _joined(stack[-1][1], here, shared, left, found))
            else:
                stack.append((shared, here))
        here = Node(x, left[x])
    while stack:
        depth, node = stack.pop()
        here = _joined(node, here, depth, left, found)
    return found


def _suffixes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes of x in order, common prefix length with the one before); every stretch of x ends in a value of its own."""
    rank, step, levels = x.astype(np.int64), 1, []
    n = len(x)
    while True:
        levels.append(rank)
        key = rank * (n + 1)
        key[:-step or None] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
        if rank[order[-1]] == n - 1:
            break
        step *= 2
    a, b, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for j in range(len(levels) - 1, -1, -1):
        i, k = a + common, b + common
        same = np.flatnonzero((i < n) & (k < n))
        same = same[levels[j][i[same]] == levels[j][k[same]]]
        common[same] += 1 << j
    return order, np.concatenate([[0], common])


def runs_of(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the documents h[off[i]:off[i + 1]], by document, start, period: (start in h, length, period)."""
    none = np.zeros(0, np.int64)
    inside = np.flatnonzero(whole(off, DEPTH))
    if not len(inside):
        return none, none, none
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    salt = mix(doc.astype(U64) + U64(1))
    key = grams(h, DEPTH)[inside] ^ salt[inside]
    order = np.argsort(key)
    s = key[order]
    twin = s[1:] == s[:-1]
    again = np.zeros(len(s), bool)
    again[1:] |= twin
    again[:-1] |= twin
    again = np.sort(inside[order[again]])
    if not len(again):
        return none, none, none
    # the words of repeated grams and one more, where the document goes on
    step = np.zeros(len(h) + DEPTH + 2, np.int32)
    np.add.at(step, again, 1)
    np.add.at(step, again + DEPTH + 1, -1)
    word = np.flatnonzero(np.cumsum(step)[:len(h)] > 0)
    cut = np.flatnonzero((np.diff(word) != 1) | (doc[word[1:]] != doc[word[:-1]])) + 1
    # one value per (document, word), and one of its own at the end of each stretch
    _, value = np.unique(mix(h[word] ^ salt[word]), return_inverse=True)
    ends = np.append(cut, len(word))
    at = np.insert(word, ends, -1)
    x = np.insert(value, ends, value.max() + 1 + np.arange(len(ends)))
    order, common = _suffixes(x)
    # only neighbours that share DEPTH words belong to a node
    deep = common >= DEPTH
    member = deep.copy()
    member[:-1] |= deep[1:]
    at, common = at[order[member]], common[member]
    begins = np.zeros(len(h) + 1, bool)
    begins[off] = True
    before = h[at - 1].tolist()
    left = {p: (-1 if b else w) for p, w, b in zip(at.tolist(), before, begins[at].tolist())}
    found = pairs_bottom_up(at.tolist(), common.tolist(), left)
    if not found:
        return none, none, none
    got = np.array([(s, n, p) for (s, n), p in found.items()], np.int64)
    got = got[np.lexsort((got[:, 2], got[:, 0]))]
    return got[:, 0], got[:, 1], got[:, 2]


def _collapse(batches, rewrite: Rewrite | None) -> Iterator[pa.RecordBatch]:
    for cols in chunks(batches, "text", CHUNK):
        texts = [t or b"" for t in cols["text"]]
        h, off = words_of(texts, lower=False)
        source: dict[int, list[int]] = {}
        if rewrite is not None:
            h = h.copy()
            for i, d in enumerate(cols["doc_id"]):
                n = int(off[i + 1] - off[i])
                numbers = rewrite(d, n) if n else None
                if numbers is not None:
                    h[off[i]:off[i + 1]] = h[off[i] + numbers]
                    source[i] = numbers.tolist()
        start, length, period = runs_of(h, off)
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, start + period, 1)
        np.add.at(step, start + length, -1)
        gone = np.cumsum(step)[:-1] > 0
        hit = np.add.reduceat(np.append(gone, False), off[:-1]) * (np.diff(off) > 0)
        kept = []
        for i, t in enumerate(texts):
            words = t.split()
            if i in source:
                words = list(map(words.__getitem__, source[i]))
            if hit[i]:
                words = compress(words, (~gone[off[i]:off[i + 1]]).tolist())
            kept.append(b" ".join(words))
        owner = np.searchsorted(off, start, side="right") - 1
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(start - off[owner]), pa.array(length), pa.array(period)], fields=list(_RUN))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols["doc_id"], pa.int64()), pa.array(np.diff(off)), pa.ListArray.from_arrays(pa.array(bounds), structs),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "kept"])


def collapse(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id bigint, text string): doc_id, n_words, runs (by start, then period), kept (the text without
    the words that a run repeats, joined by one space).  ``rewrite`` may replace words before (see ``Rewrite``)."""
    st.ship(docs.sparkSession)
    return (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(partial(_collapse, rewrite=rewrite), f"doc_id long, n_words long, runs array<{RUN}>, kept string"))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repetition in a tenth of the documents: word i >= a becomes word a + (i - a) % p.  No doc_id: none."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def digest(collapsed: DataFrame) -> DataFrame:
    """Digest columns of :func:`collapse`: the number of runs, the one of greatest exponent, checksums."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    top = F.aggregate("runs", F.lit(None).cast(RUN), lambda best, r: F.when(better(best, r), r).otherwise(best))
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return (collapsed.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"), "n_words"))
