"""Packing documents into fixed-length sequences by cutting-stock column generation (operator 11).

*Pieces.*  A document is its ids and an end id.  It gives whole sequences of
``room`` ids and one remainder; only remainders are packed with others, so a
document is cut at multiples of ``room`` alone.  The pieces are written once,
with their ids, and everything after works on the written table.

*Plan.*  The corpus enters the plan as a histogram of piece lengths, at most
``room`` numbers whatever its size.  The linear program has one row per length
(its pieces must all be used) and one column per pattern, a multiset of lengths
that fits into a sequence.  A pattern costs its padded length (``room``, or the
sum itself where that is a power of two) plus ``EXTRA`` per sequence, which
keeps short sequences for the last few pieces.  The revised simplex method
starts from a greedy basis; columns are priced by a knapsack over the dual
values (dynamic programming over the sums up to ``room``), and it ends when no
column improves, when the cost is within ``gap`` of the lower bound, or after
``rounds`` pricings (any basis is a valid plan: that only changes the padding).
The basic patterns are taken a whole number of times; the lengths that this
leaves over, fewer than one pattern per length, are packed greedily.

*Assignment.*  Pieces of one length are ranked: by their number inside the
written partition, plus the pieces of that length in earlier partitions.  The
plan's slots of a length are consecutive ranges of ranks, so a piece finds its
sequence and its offset by a binary search in the plan.  Lengths are exact, so
the pattern alone fixes all offsets: no shuffle gathers a sequence, and equal
lengths (a hot group of copies) are spread like all others.

Null text: empty, one piece with the end id alone.  Null and repeated doc_ids:
every row is a document of its own.  Empty table: no pieces.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.token_repair import CHUNK, text_blocks, worker_encoder

ROOM = 2048
#: Cost of a sequence besides its padded length, in ids.
EXTRA = 16
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary, pid int, rank long"
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("ids", pa.binary()), ("pid", pa.int32()), ("rank", pa.int64())])
_RANK_BITS = 44


# ------------------------------------------------------------------ pieces

def ranks(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Number of each value among its equals, counted on in ``seen``."""
    order = np.argsort(values, kind="stable")
    s = values[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    run = np.diff(np.append(first, len(s)))
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - np.repeat(first, run) + seen[s]
    seen[s[first]] += run
    return out


def _pieces(batches, tokenizer: str, end: int, room: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a partition's documents, with their ids as little-endian uint32."""
    pid, encoder, seen = ex.pid(), worker_encoder(tokenizer), np.zeros(room + 1, np.int64)
    for block in text_blocks(batches, CHUNK):
        doc_id, text = (block.column(block.schema.names.index(n)) for n in ("doc_id", "text"))
        ids, sizes = encoder.encode(text, end)
        n = -(-sizes // room)
        doc = np.repeat(np.arange(len(sizes)), n)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * room
        length = np.minimum(sizes[doc] - start, room)
        for lo in range(0, len(doc), 1 << 14):  # binary offsets are 32 bit
            part = slice(lo, lo + (1 << 14))
            cut = np.concatenate([[0], np.cumsum(length[part])])
            first = int(length[:lo].sum())
            data = ids[first:first + int(cut[-1])].astype("<u4")
            blob = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * 4).astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [doc_id.take(pa.array(doc[part])), pa.array(start[part]), pa.array(length[part]),
                 pa.array(sizes[doc[part]]), blob, pa.array(np.full(len(cut) - 1, pid, np.int32)),
                 pa.array(ranks(length[part], seen))], schema=_PIECE)


# ------------------------------------------------------------------ plan

def padded(total: int, room: int) -> int:
    """Length of a sequence with its padding."""
    return total if total & (total - 1) == 0 else room


def _filled(count: np.ndarray, room: int, copies: int) -> list[int]:
    """A pattern from lengths in stock: the largest, then a subset of the others (each up to ``copies`` times) whose sum leaves the least room."""
    there = np.flatnonzero(count)[::-1]
    top = int(there[0])
    left, sums, steps = room - top, 1, []
    mask = (1 << left + 1) - 1
    for x in there[np.searchsorted(-there, -left):].tolist():
        for _ in range(min(copies, int(count[x]) - (x == top), left // x)):
            steps.append((x, sums))
            sums |= sums << x & mask
        if sums >> left & 1:
            break
    at, out = sums.bit_length() - 1, [top]
    for x, before in reversed(steps):
        if not before >> at & 1:
            out.append(x)
            at -= x
    return out


def _column(pattern: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.array(pattern, np.int64), return_counts=True)


def _greedy(count: np.ndarray, room: int, whole: bool) -> list[tuple[list[int], float]]:
    """Patterns that use up ``count``, each as often as its lengths last (a whole number of times if ``whole``)."""
    left, out = count.astype(np.float64), []
    while left.any():
        pattern = _filled(np.ceil(left).astype(np.int64), room, 3 if whole else 1)
        lengths, times = _column(pattern)
        n = (left[lengths] / times).min()
        if whole:
            n = np.floor(n)
        left[lengths] -= n * times
        out.append((pattern, float(n)))
    return out


def _knapsack(value: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """For every sum up to ``room``: largest value of lengths with exactly that sum, and one length of them."""
    best, pick = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for t in range(1, room + 1):
        sums = best[t - 1::-1] + value[1:t + 1]
        i = int(sums.argmax())
        best[t], pick[t] = sums[i], i + 1
    return best, pick


def _traced(pick: np.ndarray, total: int) -> list[int]:
    out = []
    while total:
        out.append(int(pick[total]))
        total -= out[-1]
    return out


class Master:
    """Revised simplex over patterns: min cost, every length used exactly as often as it occurs."""

    def __init__(self, count: np.ndarray, room: int):
        self.room = room
        self.lengths = np.flatnonzero(count)
        self.row = np.zeros(room + 1, np.int64)
        self.row[self.lengths] = np.arange(len(self.lengths))
        m = len(self.lengths)
        # Slightly unequal stocks keep the method from turning on the spot where many counts are equal.
        stock = count + np.where(count > 0, 1e-5 * (np.arange(len(count)) * 0.6180339887 % 1.0), 0.0)
        # A greedy pattern ends the stock of at least one length, so the columns are triangular; lengths that ended
        # together with another get a column of their own, at level zero.
        start = _greedy(stock, room, whole=False)
        ended = {x: i for i, (p, _) in enumerate(start) for x in p}
        spare = np.ones(room + 1, bool)
        spare[list({i: x for x, i in ended.items()}.values())] = False
        alone = self.lengths[spare[self.lengths]].tolist()
        self.patterns = [p for p, _ in start] + [[x] for x in alone]
        self.level = np.array([n for _, n in start] + [0.0] * len(alone))
        basis = np.zeros((m, m))
        for j, p in enumerate(self.patterns):
            lengths, times = _column(p)
            basis[self.row[lengths], j] = times
        self.inverse = np.linalg.inv(basis)
        self.dual = np.array([self.cost(sum(p)) for p in self.patterns]) @ self.inverse

    def cost(self, total: int) -> float:
        return padded(total, self.room) + EXTRA

    def value(self) -> float:
        return float(sum(self.cost(sum(p)) * x for p, x in zip(self.patterns, self.level)))

    def enter(self, pattern: list[int]) -> bool:
        """Bring a pattern into the basis if it lowers the cost."""
        lengths, times = _column(pattern)
        rows = self.row[lengths]
        reduced = self.cost(sum(pattern)) - float(self.dual[rows] @ times)
        if reduced > -1e-6:
            return False
        d = self.inverse[:, rows] @ times
        can = np.flatnonzero(d > 1e-7)
        if not len(can):
            return False
        ratio = self.level[can] / d[can]
        step = ratio.min()
        tied = can[ratio <= step + 1e-12]
        out = int(tied[d[tied].argmax()])
        pivot = self.inverse[out] / d[out]
        there, moved = np.flatnonzero(pivot), np.flatnonzero(np.abs(d) > 1e-12)
        self.inverse[np.ix_(moved, there)] -= np.outer(d[moved], pivot[there])
        self.inverse[out] = pivot
        self.level = np.maximum(self.level - step * d, 0)
        self.level[out] = step
        self.dual += reduced * pivot
        self.patterns[out] = pattern
        return True

    def solve(self, bound: float, gap: float, rounds: int, columns: int = 64) -> int:
        """Price columns until nothing improves enough; returns the number of pricings."""
        room = self.room
        cost = np.array([np.inf] + [self.cost(t) for t in range(1, room + 1)])
        for done in range(rounds):
            now = self.value()
            if now <= bound * (1 + gap):
                return done
            value = np.full(room + 1, -np.inf)
            value[self.lengths] = self.dual
            best, pick = _knapsack(value, room)
            # cost / best ratio: the duals divided by it are feasible, a lower bound on any plan
            if now / max(1.0, float((best[1:] / cost[1:]).max())) >= now / (1 + gap):
                return done
            # the best pattern of every sum, and for every length the best full pattern that holds it
            sums = np.flatnonzero(cost - best < -1e-6)
            with_length = value[self.lengths] + np.array([best[:room - x + 1].max() for x in self.lengths])
            order = np.argsort(-with_length, kind="stable")[:columns]
            fresh = [_traced(pick, int(t)) for t in sums[np.argsort((cost - best)[sums], kind="stable")][:columns // 4]]
            for i in order[room + EXTRA - with_length[order] < -1e-6]:
                x = int(self.lengths[i])
                fresh.append([x, *_traced(pick, int(best[:room - x + 1].argmax()))])
            if not sum(self.enter(p) for p in fresh):
                return done + 1
        return rounds


def plan(count: np.ndarray, room: int = ROOM, gap: float = 5e-4, rounds: int = 60) -> list[tuple[list[int], int]]:
    """Patterns (lengths, descending) and how many sequences take each; all of ``count`` (by length) is used."""
    count = np.asarray(count, np.int64).copy()
    out: list[tuple[list[int], int]] = []
    if len(count) > room and count[room]:
        out.append(([room], int(count[room])))
        count[room] = 0
    if count.any():
        master = Master(count, room)
        bound = float((np.arange(len(count)) * count).sum()) * (1 + EXTRA / room)
        master.solve(bound, gap, rounds)
        for pattern, level in zip(master.patterns, master.level):
            lengths, times = _column(pattern)
            n = min(int(np.floor(level + 1e-3)), int((count[lengths] // times).min()))
            if n:
                out.append((sorted(pattern, reverse=True), n))
                count[lengths] -= n * times
        out.extend((sorted(p, reverse=True), int(n)) for p, n in _greedy(count, room, whole=True))
    return out


class Slots:
    """Where the plan puts the r-th piece of a length."""

    def __init__(self, patterns: list[tuple[list[int], int]]):
        rows, sequence, used = [], 0, {}
        for pattern, n in patterns:
            lengths, times = _column(pattern)
            offset = 0
            for x, k in zip(lengths[::-1].tolist(), times[::-1].tolist()):
                rows.append(((x << _RANK_BITS) + used.get(x, 0), k, offset, sequence))
                used[x] = used.get(x, 0) + k * n
                offset += k * x
            sequence += n
        self.key, self.times, self.offset, self.first = np.array(sorted(rows), np.int64).reshape(-1, 4).T

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset in it)."""
        key = (length << _RANK_BITS) + rank
        i = np.searchsorted(self.key, key, side="right") - 1
        nth = key - self.key[i]
        return self.first[i] + nth // self.times[i], self.offset[i] + nth % self.times[i] * length


def _placed(batches, slots: Slots) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.schema.names
        sequence, offset = slots.place(b.column(names.index("length")).to_numpy(), b.column(names.index("nth")).to_numpy())
        keep = [n for n in names if n != "nth"]
        yield pa.RecordBatch.from_arrays([*(b.column(names.index(n)) for n in keep), pa.array(sequence), pa.array(offset)],
                                         names=[*keep, "sequence_id", "offset"])


# ------------------------------------------------------------------ operator

def pack(docs: DataFrame, tokenizer: str, end: int = 1, room: int = ROOM, gap: float = 5e-4, rounds: int = 60,
         with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id bigint, text string) and their places.

    doc_id, start (ids of the document before the piece), length, ids_crc32,
    doc_tokens, sequence_id, offset, and with ``with_ids`` the ids
    (little-endian uint32) for :func:`sequences`.
    """
    if room < 2 or room & (room - 1):
        raise ValueError("room must be a power of two")
    spark = docs.sparkSession
    store = st.new_store(spark, "packing")
    (docs.select("doc_id", "text").mapInArrow(partial(_pieces, tokenizer=tokenizer, end=end, room=room), PIECE_SCHEMA)
     .write.option("compression", "zstd").option("parquet.enable.dictionary", "false")
     .option("parquet.block.size", 16 << 20).parquet(f"{store}/pieces"))
    pieces = spark.read.schema(PIECE_SCHEMA).parquet(f"{store}/pieces")
    counts = st.saved(pieces.groupBy("pid", "length").agg((F.max("rank") + 1).alias("n")), store, "counts")
    # at most ``room`` rows, whatever the input
    count = np.zeros(room + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        count[r["length"]] = r["n"]
    slots = Slots(plan(count, room, gap, rounds))
    # rows of a length: one per written partition
    earlier = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("pid", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    cols = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", *(["ids"] if with_ids else [])]
    # counts grow with the written partitions, so they are joined by key, never broadcast
    rows = (pieces.select(*cols, "pid", "rank").join(before.hint("merge"), ["pid", "length"])
            .withColumn("nth", F.col("rank") + F.col("before")).drop("pid", "rank", "before"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names) + ", sequence_id long, offset long"
    return rows.select(*names, "nth").mapInArrow(partial(_placed, slots=slots), schema)


def sequences(packed: DataFrame, room: int = ROOM, pad: int = 0) -> DataFrame:
    """The packed sequences (from ``pack(..., with_ids=True)``): sequence_id, n_ids, ids with padding, doc starts."""
    total = F.sum("length")
    # a sequence holds at most ``room`` pieces
    rows = packed.groupBy("sequence_id").agg(
        total.alias("n_ids"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    size = F.when((F.col("n_ids").bitwiseAND(F.col("n_ids") - 1)) == 0, F.col("n_ids")).otherwise(room)
    filler = F.unhex(F.repeat(F.lit(int(pad).to_bytes(4, "little").hex()), (size - F.col("n_ids")).cast("int")))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return rows.select("sequence_id", "n_ids", F.concat(joined, filler).alias("ids"),
                       F.transform("parts", lambda p: p["offset"]).alias("offsets"))
