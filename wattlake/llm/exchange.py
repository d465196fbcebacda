"""Counting keys across all partitions and giving each its answer back.

A pass over the documents emits, per chunk, an array of 64-bit keys.  The keys
travel packed (one binary row per chunk and shard), each shard counts its keys
in one task, and the answer returns as an array aligned with the keys: no key
ever becomes a row.  Answers land in one side file per document partition, for
the next pass over that partition.  Every block's memory is bounded by the
chunk, every shard's by keys / shards, and keys are hashes, so no shard is hot.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import store as st
from wattlake.llm.textvec import U64, give_back

BLOCK_SCHEMA = "shard int, pid int, chunk int, data binary"
_BLOCK = pa.schema([("shard", pa.int32()), ("pid", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary())])


def by_shard(shard: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(stable order by shard, bounds of each shard in that order)."""
    order = np.argsort(shard.astype(np.uint16), kind="stable")
    return order, np.searchsorted(shard[order], np.arange(n + 1))


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> U64(40)) % U64(n)).astype(np.int64)


def pack(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(U64).ravel()


def key_blocks(keys: np.ndarray, pid: int, chunk: int, n: int, width: int) -> pa.RecordBatch:
    """The keys of one chunk as one row per shard."""
    order, bounds = by_shard(shard_of(keys, n), n)
    keys = keys[order]
    full = [s for s in range(n) if bounds[s + 1] > bounds[s]]
    return rows(full, pid, chunk, [pack(keys[bounds[s]:bounds[s + 1]], width) for s in full])


def rows(shards: list[int], pid: int, chunk: int, data: list[bytes]) -> pa.RecordBatch:
    k = len(shards)
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), pa.array([pid] * k, pa.int32()), pa.array([chunk] * k, pa.int32()),
         pa.array(data, pa.binary())], schema=_BLOCK)


def gathered(batches) -> list[tuple[int, int, int, bytes]]:
    """All blocks that reached a task, in (shard, pid, chunk) order."""
    out = []
    for b in batches:
        out.extend(zip(*(b.column(i).to_pylist() for i in range(4))))
    out.sort(key=lambda r: r[:3])
    return out


def answered(blocks: DataFrame, answer: Callable[[list[bytes]], list[bytes]], n_shards: int, n_pids: int,
             store: str, name: str, given: bool = False) -> None:
    """Run ``answer`` on each shard's blocks; write each partition's answers to ``name``/pid.

    ``given``: blocks of pid -1 are data for the shard, passed to ``answer`` as a first argument.
    """

    def reduce(batches) -> Iterator[pa.RecordBatch]:
        got = gathered(batches)
        i = 0
        while i < len(got):
            j = i
            while j < len(got) and got[j][0] == got[i][0]:
                j += 1
            part, got[i:j] = got[i:j], [None] * (j - i)
            i = j
            if given:
                data, part = [r[3] for r in part if r[1] < 0], [r for r in part if r[1] >= 0]
                replies = answer(data, [r[3] for r in part]) if part else []
            else:
                replies = answer([r[3] for r in part])
            for r, reply in zip(part, replies):
                yield rows([r[0]], r[1], r[2], [reply])
            del part, replies
            give_back()

    def write(batches) -> Iterator[pa.RecordBatch]:
        by_pid: dict[int, list] = {}
        for s, pid, chunk, data in gathered(batches):
            by_pid.setdefault(pid, []).append((chunk, s, data))
        for pid, items in by_pid.items():
            buf = io.BytesIO()
            for chunk, s, data in sorted(items, key=lambda x: x[:2]):
                buf.write(np.array([chunk, s, len(data)], np.int64).tobytes())
                buf.write(data)
            st.put(store, f"{name}/{pid}", buf.getbuffer())
        yield pa.RecordBatch.from_arrays([pa.array([len(by_pid)], pa.int64())], names=["n"])

    back = blocks.repartitionById(n_shards, "shard").mapInArrow(reduce, BLOCK_SCHEMA)
    back.repartitionById(n_pids, "pid").mapInArrow(write, "n bigint").agg({"n": "sum"}).collect()


class Answers:
    """Reads the answers of one document partition, chunk by chunk."""

    def __init__(self, store: str, name: str, pid: int):
        data = st.get(store, f"{name}/{pid}") or b""
        self.parts: dict[int, dict[int, bytes]] = {}
        at = 0
        while at < len(data):
            chunk, s, n = np.frombuffer(data, np.int64, 3, at).tolist()
            self.parts.setdefault(chunk, {})[s] = data[at + 24:at + 24 + n]
            at += 24 + n

    def aligned(self, chunk: int, keys: np.ndarray, n: int, dtype) -> np.ndarray:
        """One value per key, in the keys' order."""
        parts = self.parts.pop(chunk, {})
        flat = np.frombuffer(b"".join(parts[s] for s in sorted(parts)), dtype)
        if len(flat) != len(keys):
            raise RuntimeError(f"{len(flat)} answers for {len(keys)} keys: the input changed between two passes")
        order, _ = by_shard(shard_of(keys, n), n)
        out = np.empty(len(keys), dtype)
        out[order] = flat
        return out


def count_answer(width: int) -> Callable[[list[bytes]], list[bytes]]:
    """Answer every key with how often it occurs in its shard (255: that or more)."""

    def answer(blocks: list[bytes]) -> list[bytes]:
        sizes = [len(b) // width for b in blocks]
        keys = unpack(b"".join(blocks), width)
        order = np.argsort(keys)
        s = keys[order]
        new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        runs = np.diff(np.append(new, len(s)))
        out = np.empty(len(keys), np.uint8)
        out[order] = np.repeat(np.minimum(runs, 255).astype(np.uint8), runs)
        return [x.tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]

    return answer


def pid() -> int:
    return TaskContext.get().partitionId()


REF_BITS = 33


def with_rows(docs: DataFrame, store: str, wanted: DataFrame, name: str = "wanted") -> DataFrame:
    """The rows of ``docs`` (a plain scan) whose ref is in ``wanted`` (column ref), all columns, without a shuffle of ``docs``.

    A ref is (partition << REF_BITS) + row number.  Each partition's wanted row
    numbers go to a side file; repeated refs repeat the row.
    """
    n_pids = max(1, docs.rdd.getNumPartitions())

    def write(batches) -> Iterator[pa.RecordBatch]:
        refs = [b.column(1).to_numpy() for b in batches]
        r = np.sort(np.concatenate(refs)) if refs else np.zeros(0, np.int64)
        p = r >> REF_BITS
        for i in np.unique(p):
            st.put(store, f"{name}/{i}", (r[p == i] & ((1 << REF_BITS) - 1)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([len(r)], pa.int64())], names=["n"])

    (wanted.select(F.shiftright("ref", REF_BITS).cast("int").alias("pid"), "ref")
     .repartitionById(n_pids, "pid").mapInArrow(write, "n long").agg({"n": "sum"}).collect())

    def pick(batches) -> Iterator[pa.RecordBatch]:
        rows_, base = np.frombuffer(st.get(store, f"{name}/{pid()}") or b"", np.int64), 0
        for b in batches:
            lo, hi = np.searchsorted(rows_, [base, base + b.num_rows])
            base += b.num_rows
            if hi > lo:
                yield b.take(pa.array(rows_[lo:hi] - (base - b.num_rows)))

    return docs.mapInArrow(pick, docs.schema)
