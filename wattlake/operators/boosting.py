"""Gradient-boosted regression trees that stop when the validation rows stop improving.

Spark's own booster ends at the first round without enough gain on the
validation rows; there is no patience, so a full budget of rounds can only be
had without early stopping.  This one grows the same trees (squared loss, first
tree in full, later ones fitted to twice the residual and shrunk, the same
candidate splits, variance gain, rows and features drawn per tree and node) and
ends a model once ``patience`` rounds in a row bring no better validation error.
The trees up to the best round become a ``GBTRegressionModel``.

Features become bin numbers once (two reads of the rows), written as blocks of
rows.  A level of a tree needs one histogram per node: rows and label sums per
feature and bin.  Up to ``LOCAL_ROWS`` rows, a task holds all blocks and grows a
whole model, one task per model.  Beyond, every job advances up to ``SLOTS``
models by a level: the blocks add up their histograms, and splits are chosen
where the histograms of a few nodes meet, so the driver sees splits only.

What a model predicts for the rows of a block so far is a function of the block
and the trees.  Workers keep it in a local file; a worker that has none, or an
old one, applies the trees it lacks, so no state is lost with a worker.
"""

from __future__ import annotations

import json
import math
import os
import shutil
import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import scratch_dir, ship_package, written_once

BINS = 32
BLOCK_ROWS = 1 << 15
LOCAL_ROWS = 1 << 21
SLOTS = 16
CHUNK_NODES = 16
RECENT = 4
SUMMARY = 1 << 12
SMALL_BYTES = 1 << 24

_BLOCK = pa.schema([("block", pa.int64()), ("train", pa.bool_()), ("n", pa.int64()), ("bins", pa.binary()),
                    ("label", pa.binary())])
_SUMMARY = pa.schema([("feature", pa.int32()), ("values", pa.binary()), ("counts", pa.binary())])
_PART = pa.schema([("model", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary())])


class Setting(NamedTuple):
    """One model: GBTRegressor's parameters, and the rounds without a better validation error that end it."""

    rounds: int
    step: float
    depth: int
    min_rows: int
    sample: float
    features: int
    patience: int
    seed: int


def setting(n_features: int, seed: int = 42, maxIter: int = 20, stepSize: float = 0.1, maxDepth: int = 5,
            minInstancesPerNode: int = 1, subsamplingRate: float = 1.0, featureSubsetStrategy: str = "all",
            patience: int = 10) -> Setting:
    """The setting of parameters named as GBTRegressor's, with its defaults."""
    if maxIter < 1 or not 0 < stepSize <= 1 or not 0 <= maxDepth <= 30 or minInstancesPerNode < 1 or not 0 < subsamplingRate <= 1 or patience < 1:
        raise ValueError("maxIter, minInstancesPerNode, patience >= 1; stepSize, subsamplingRate in (0, 1]; maxDepth in 0..30")
    return Setting(maxIter, stepSize, maxDepth, minInstancesPerNode, subsamplingRate,
                   features_per_node(str(featureSubsetStrategy), n_features), patience, seed)


def features_per_node(strategy: str, n: int) -> int:
    """Features tried at a node, by the strategy names of Spark ML."""
    named = {"auto": n, "all": n, "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))),
             "onethird": math.ceil(n / 3)}
    if strategy in named:
        return named[strategy]
    value = int(strategy) if strategy.isdigit() else float(strategy)
    if value <= 0 or (isinstance(value, float) and value > 1):
        raise ValueError(f"featureSubsetStrategy {strategy}")
    return min(n, value) if isinstance(value, int) else math.ceil(value * n)


# ------------------------------------------------------------- bins and blocks

def compress(values: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` of the sorted values, each with the rows up to it; as they are if there are no more."""
    if len(values) <= k:
        return values, counts
    total = np.cumsum(counts)
    last = np.flatnonzero(np.append(np.diff((total * k - 1) // total[-1]) > 0, True))
    return values[last], np.diff(total[last], prepend=0)


def merge(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, where = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(where, np.concatenate([c for _, c in parts]), len(values)).astype(np.int64)


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Spark ML's candidate splits of a feature: midpoints between all values, or between those next to equal shares."""
    middle = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return middle
    stride = counts.sum() / bins
    out, target, seen = [], stride, int(counts[0])
    for i in range(1, len(values)):
        before, seen = seen, seen + int(counts[i])
        if abs(before - target) < abs(seen - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out[:bins - 1])


def _columns(batch: pa.RecordBatch, feats: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(f).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for f in feats]


def _summarise(feats: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.empty(0), np.empty(0, np.int64))] * len(feats)
        held: list[list[np.ndarray]] = []

        def fold() -> None:
            for i in range(len(feats)):
                x = np.concatenate([h[i] for h in held])
                kept[i] = compress(*merge([kept[i], np.unique(x[~np.isnan(x)], return_counts=True)]), 8 * SUMMARY)
            held.clear()
        rows = 0
        for batch in batches:
            held.append(_columns(batch, feats))
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                fold()
                rows = 0
        if held:
            fold()
        kept = [compress(v, c, SUMMARY) for v, c in kept]
        yield pa.record_batch([pa.array(range(len(feats)), pa.int32()), pa.array([v.tobytes() for v, _ in kept], pa.binary()),
                               pa.array([c.tobytes() for _, c in kept], pa.binary())], schema=_SUMMARY)
    return run


def _merge_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            parts.setdefault(r["feature"], []).append((np.frombuffer(r["values"]), np.frombuffer(r["counts"], np.int64)))
    for f, p in parts.items():
        v, c = compress(*merge(p), 64 * SUMMARY)
        yield pa.record_batch([pa.array([f], pa.int32()), pa.array([v.tobytes()], pa.binary()),
                               pa.array([c.tobytes()], pa.binary())], schema=_SUMMARY)


def candidate_splits(train: DataFrame, feats: Sequence[str]) -> list[np.ndarray]:
    """Thresholds per feature, from the values of all training rows (exact up to ``SUMMARY`` distinct ones in a task)."""
    parts = train.mapInArrow(_summarise(feats), "feature int, values binary, counts binary")
    merged = parts.repartition(len(feats), "feature").mapInArrow(_merge_summaries, parts.schema).collect()
    out = [np.empty(0)] * len(feats)
    for r in merged:
        out[r["feature"]] = thresholds(np.frombuffer(r["values"]), np.frombuffer(r["counts"], np.int64))
    return out


def _blocked(feats: Sequence[str], label: str, flag: str, splits: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = (TaskContext.get().partitionId() + 1) << 32, 0
        held: dict[bool, list] = {True: [], False: []}

        def block(train: bool) -> pa.RecordBatch:
            nonlocal made
            bins = np.concatenate([b for b, _ in held[train]], axis=1)
            y = np.concatenate([v for _, v in held[train]])
            held[train] = []
            made += 1
            return pa.record_batch([pa.array([base + made]), pa.array([train]), pa.array([len(y)]),
                                    pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], schema=_BLOCK)
        for batch in batches:
            y = _columns(batch, [label])[0]
            if np.isnan(y).any():
                raise ValueError(f"{label} is null or not a number in a training or validation row")
            # a value up to threshold i is in bin i; no value (NaN) is in the last, as Spark's trees send it to the right
            bins = np.stack([np.searchsorted(s, x).astype(np.uint8) for s, x in zip(splits, _columns(batch, feats))])
            held_out = batch.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            for train in (True, False):
                of = ~held_out if train else held_out
                if of.any():
                    held[train].append((bins[:, of], y[of]))
                    if sum(len(v) for _, v in held[train]) >= BLOCK_ROWS:
                        yield block(train)
        for train in (True, False):
            if held[train]:
                yield block(train)
    return run


@dataclass
class Data:
    """Rows as bin numbers: ``blocks`` (block, train, n, bins, label) and the thresholds between a feature's bins."""

    blocks: DataFrame
    splits: list[np.ndarray]
    train_rows: int
    val_rows: int

    @property
    def n_features(self) -> int:
        return len(self.splits)


def prepare(rows: DataFrame, feats: Sequence[str], label: str, flag: str) -> Data:
    """Bins and blocks of ``rows``; those with ``flag`` are for validation."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in (*feats, label)], F.coalesce(flag, F.lit(False)).alias(flag))
    splits = candidate_splits(rows.where(~F.col(flag)), feats)
    blocks = rows.mapInArrow(_blocked(feats, label, flag, splits), "block long, train boolean, n long, bins binary, label binary")
    blocks = written_once(blocks.repartition(spark.sparkContext.defaultParallelism), "boosting")
    count = blocks.agg(F.sum(F.when(F.col("train"), F.col("n"))).alias("t"), F.sum(F.when(~F.col("train"), F.col("n"))).alias("v")).first()
    if not count["t"]:
        raise ValueError("no training rows")
    return Data(blocks, splits, count["t"], count["v"] or 0)


# ------------------------------------------------------------------ one model

class Tree:
    """Nodes in the order of their levels: ``feature`` (-1: leaf), ``cut`` (bins up to it go left), ``left`` child (the
    right one is next), ``value``; and rows, label sum, sum of squares and gain of each."""

    STATS = ("n", "s", "ss", "gain")

    def __init__(self, feature=(-1,), cut=(0,), left=(0,), value=(0.0,), depth=0):
        self.feature = np.array(feature, np.int16)
        self.cut = np.array(cut, np.uint8)
        self.left = np.array(left, np.int32)
        self.value = np.array(value, np.float64)
        self.depth = depth
        self.stats = {k: np.full(len(self.left), np.nan) for k in self.STATS}

    def route(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The rows' nodes, one level further down."""
        f = self.feature[node]
        rows = np.flatnonzero(f >= 0)
        at = node[rows]
        out = node.copy()
        out[rows] = self.left[at] + (bins[f[rows], rows] > self.cut[at])
        return out

    def slim(self) -> "Tree":
        """Without the statistics, which prediction does not need."""
        out = Tree.__new__(Tree)
        out.feature, out.cut, out.left, out.value, out.depth, out.stats = self.feature, self.cut, self.left, self.value, self.depth, {}
        return out


class Booster:
    """A model while it grows.  ``level`` of the tree of ``round`` comes next: its open nodes are ``start`` and all after."""

    def __init__(self, number: int, given: Setting, n_features: int, validate: bool, keep: bool):
        self.number, self.given, self.n_features, self.validate, self.keep = number, given, n_features, validate, keep
        self.trees: list[Tree] = []
        self.errors: list[float] = []
        self.best = 0
        self.done = False
        self._plant()

    def _plant(self) -> None:
        self.tree, self.level, self.start = Tree(), 0, 0

    @property
    def round(self) -> int:
        return len(self.trees)

    @property
    def width(self) -> int:
        return len(self.tree.left) - self.start

    def weight(self, i: int) -> float:
        return 1.0 if i == 0 else self.given.step

    def scored(self, sse: float, rows: int) -> None:
        """The validation error of the trees so far, known before the next one starts."""
        self.errors.append(sse / rows)
        if self.errors[-1] < self.errors[self.best - 1] or not self.best:
            self.best = len(self.errors)
        self.done = len(self.errors) - self.best >= self.given.patience or self.round == self.given.rounds

    def split(self, best: np.ndarray) -> bool:
        """Take the ``best_splits`` of the open nodes; true if that was the tree's last level."""
        t, start, end = self.tree, self.start, len(self.tree.left)
        for k in Tree.STATS:
            t.stats[k][start:end] = best[k]
        t.value[start:end] = np.divide(best["s"], best["n"], out=np.zeros(end - start), where=best["n"] > 0)
        cut = np.flatnonzero(best["feature"] >= 0) if self.level < self.given.depth else np.empty(0, np.intp)
        if len(cut):
            t.feature[start + cut], t.cut[start + cut] = best["feature"][cut], best["cut"][cut]
            t.left[start + cut] = end + 2 * np.arange(len(cut))
            n = np.stack([best["ln"][cut], best["n"][cut] - best["ln"][cut]], 1).ravel()
            s = np.stack([best["ls"][cut], best["s"][cut] - best["ls"][cut]], 1).ravel()
            new = Tree([-1] * len(n), [0] * len(n), [0] * len(n), s / n)
            new.stats["n"], new.stats["s"] = n, s
            for k in ("feature", "cut", "left", "value"):
                setattr(t, k, np.concatenate([getattr(t, k), getattr(new, k)]))
            t.stats = {k: np.concatenate([t.stats[k], new.stats[k]]) for k in Tree.STATS}
            t.depth = self.level + 1
        self.start, self.level = end, self.level + 1
        if len(cut) and self.level < self.given.depth:
            return False
        t.stats["gain"][t.feature < 0] = -1.0
        self.trees.append(t if self.keep else t.slim())
        self._plant()
        if not self.validate:
            self.best, self.done = self.round, self.round == self.given.rounds
        return True


def block_rows(block: int, n: int, s: Setting, round_: int) -> np.ndarray | None:
    """Which rows of a block a round's tree is grown from; None for all."""
    if s.sample >= 1:
        return None
    return np.random.default_rng([s.seed, round_, block]).random(n, np.float32) < s.sample


def histograms(bins: np.ndarray, target: np.ndarray, node: np.ndarray, chosen: np.ndarray | None, start: int,
               width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and target sums per feature, open node and bin, and the open nodes' sums of squares."""
    keep = node >= start if start else None
    if chosen is not None:
        keep = chosen if keep is None else keep & chosen
    rows = None if keep is None else np.flatnonzero(keep)
    if rows is not None:
        target, node = target[rows], node[rows]
    at = node.astype(np.intp) - start
    base = at * BINS
    out = np.empty((len(bins), 2, width * BINS))
    for f in range(len(bins)):
        code = base + (bins[f] if rows is None else bins[f][rows])
        out[f, 0] = np.bincount(code, minlength=width * BINS)
        out[f, 1] = np.bincount(code, target, width * BINS)
    return out, np.bincount(at, target * target, width)


_BEST = np.dtype([("feature", "<i2"), ("cut", "u1"), ("ln", "<f8"), ("ls", "<f8"), *[(k, "<f8") for k in Tree.STATS]])


def best_splits(hist: np.ndarray, squares: np.ndarray, s: Setting, round_: int, start: int, first: int, width: int) -> np.ndarray:
    """The best split of each node of a histogram (feature -1: none), by the drop of the variance; the first of equal ones.
    The histogram begins at node ``first`` of the level's ``width`` open nodes."""
    f_n, nodes = hist.shape[0], len(squares)
    left = np.cumsum(hist.reshape(f_n, 2, nodes, BINS), axis=3).transpose(2, 0, 3, 1)  # node, feature, bin, (rows, sum)
    ln, ls = left[..., 0], left[..., 1]
    n, total = ln[:, 0, -1], ls[:, 0, -1]
    rn, rs = n[:, None, None] - ln, total[:, None, None] - ls
    allowed = (ln >= s.min_rows) & (rn >= s.min_rows)
    if s.features < f_n:
        order = np.random.default_rng([s.seed, round_, start, 1]).random((width, f_n))[first:first + nodes].argsort(axis=1).argsort(axis=1)
        allowed &= (order < s.features)[..., None]
    with np.errstate(divide="ignore", invalid="ignore"):
        base = np.where(n > 0, total * total / n, 0.0)
        gain = np.where(allowed, ls * ls / ln + rs * rs / rn - base[:, None, None], -np.inf).reshape(nodes, -1)
    top = gain.argmax(axis=1)
    at = np.arange(nodes)
    out = np.zeros(nodes, _BEST)
    found = gain[at, top] > 1e-12 * np.maximum(squares, 1e-300)
    out["feature"] = np.where(found, top // BINS, -1)
    out["cut"] = top % BINS
    out["ln"], out["ls"] = ln.reshape(nodes, -1)[at, top], ls.reshape(nodes, -1)[at, top]
    out["n"], out["s"], out["ss"] = n, total, squares
    out["gain"] = np.where(found, gain[at, top] / np.maximum(n, 1), -1.0)
    return out


def _target(label: np.ndarray, pred: np.ndarray, round_: int) -> np.ndarray:
    """What a round's tree is fitted to: the labels, then the negative gradient of the squared error."""
    return label if round_ == 0 else 2 * (label - pred)


# ------------------------------------------------- a whole model in one task

def _grow(booster: Booster, blocks: list) -> Booster:
    """Grow a model from all its blocks (block, train, bins, label)."""
    state = [[np.zeros(len(y), np.float32), np.zeros(len(y), np.int32)] for *_, y in blocks]
    while not booster.done:
        if booster.level == 0:
            target = [_target(y, p, booster.round) for (_, _, _, y), (p, _) in zip(blocks, state)]
            chosen = [block_rows(b, len(y), booster.given, booster.round) if train else None for b, train, _, y in blocks]
        hist, squares = 0.0, 0.0
        for (_, train, bins, _), (_, node), t, c in zip(blocks, state, target, chosen):
            if train:
                h, q = histograms(bins, t, node, c, booster.start, booster.width)
                hist, squares = hist + h, squares + q
        found = best_splits(hist, squares, booster.given, booster.round, booster.start, 0, booster.width)
        tree = booster.tree
        last = booster.split(found)
        sse, rows = 0.0, 0
        for (_, train, bins, y), st in zip(blocks, state):
            if not last:
                st[1] = tree.route(bins, st[1]) if train else st[1]
                continue
            node = st[1]
            for _ in range(0 if train else tree.depth - 1):  # training rows are at the last level but one already
                node = tree.route(bins, node)
            if tree.depth:
                node = tree.route(bins, node)
            st[0] += (booster.weight(booster.round - 1) * tree.value[node]).astype(np.float32)
            st[1] = np.zeros(len(y), np.int32)
            if not train:
                sse, rows = sse + float(((y - st[0]) ** 2).sum()), rows + len(y)
        if last and booster.validate:
            booster.scored(sse, rows)
    return booster


def _in_tasks(data: Data, boosters: list[Booster]) -> list[Booster]:
    sc = data.blocks.sparkSession.sparkContext
    f = data.n_features
    held = sc.broadcast([(r["block"], r["train"], bytes(r["bins"]), bytes(r["label"])) for r in data.blocks.orderBy("block").collect()])

    def run(booster: Booster) -> Booster:
        blocks = [(b, t, np.frombuffer(x, np.uint8).reshape(f, -1), np.frombuffer(y)) for b, t, x, y in held.value]
        done = _grow(booster, blocks)
        if not done.keep:
            done.trees = []
        return done
    try:
        return sc.parallelize(boosters, len(boosters)).map(run).collect()
    finally:
        held.destroy()


# ------------------------------------------------- many models, level by level

class Request(NamedTuple):
    """What a job does for a model: its next level, and the trees that a block's predictions may lack."""

    slot: int
    model: int
    given: Setting
    round: int
    level: int
    start: int
    width: int
    tree: Tree
    recent: list[Tree]       # trees from ``since`` on
    since: int
    older: list              # (first tree, how many, broadcast of them)


class _State:
    """Predictions and nodes of a block's rows under a model, kept in a file of the worker.  Files are written in place;
    the checksum tells one that another attempt of a task is writing, which counts as none."""

    def __init__(self, folder: str, block: int, n: int):
        self.folder, self.block, self.n = folder, block, n

    def load(self, r: Request) -> None:
        self.path = os.path.join(self.folder, f"{r.slot}-{self.block}")
        self.nodes = np.dtype(np.uint16 if r.given.depth <= 14 else np.int32)
        self.round = self.level = 0
        size = self.n * (4 + self.nodes.itemsize)
        try:
            with open(self.path, "rb", buffering=0) as f:
                raw = f.read(32 + size)
        except FileNotFoundError:
            raw = b""
        if len(raw) == 32 + size:
            model, round_, level, crc = np.frombuffer(raw, np.int64, 4)
            if model == r.model and (round_, level) <= (r.round, r.level) and crc == zlib.crc32(memoryview(raw)[32:], int(round_ << 8 | level)):
                self.round, self.level = int(round_), int(level)
                self.pred = np.frombuffer(raw, np.float32, self.n, 32).copy()
                self.node = np.frombuffer(raw, self.nodes, self.n, 32 + 4 * self.n).astype(np.int32)
                return
        self.pred, self.node = np.zeros(self.n, np.float32), np.zeros(self.n, np.int32)

    def advance(self, r: Request, bins: np.ndarray) -> None:
        """Apply the trees that are done and the levels of the one that grows."""
        while self.round < r.round:
            tree = r.recent[self.round - r.since] if self.round >= r.since else next(
                held.value[self.round - first] for first, count, held in r.older if first <= self.round < first + count)
            for _ in range(self.level, tree.depth):
                self.node = tree.route(bins, self.node)
            self.pred += ((1.0 if self.round == 0 else r.given.step) * tree.value[self.node]).astype(np.float32)
            self.node[:] = 0
            self.round, self.level = self.round + 1, 0
        for _ in range(self.level, r.level):
            self.node = r.tree.route(bins, self.node)
        self.level = r.level

    def save(self, r: Request) -> None:
        data = self.pred.tobytes() + self.node.astype(self.nodes).tobytes()
        head = np.array([r.model, self.round, self.level, zlib.crc32(data, self.round << 8 | self.level)], np.int64)
        f = os.open(self.path, os.O_WRONLY | os.O_CREAT, 0o600)
        try:
            os.writev(f, [head.tobytes(), data])
        finally:
            os.close(f)


def _parts(requests: list[Request], name: str):
    """Histograms of the blocks of a task, in rows of ``CHUNK_NODES`` nodes; validation errors under chunk -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = os.path.join(SparkFiles.getRootDirectory(), name)
        os.makedirs(folder, exist_ok=True)
        sums: dict[int, list] = {}
        errors: dict[int, np.ndarray] = {}
        f = 0
        for batch in batches:
            for i in range(batch.num_rows):
                block, train, n = (batch.column(c)[i].as_py() for c in ("block", "train", "n"))
                bins = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(-1, n)
                y = np.frombuffer(batch.column("label")[i].as_buffer())
                f = len(bins)
                state = _State(folder, block, n)
                for r in requests:
                    if not train and (r.level or not r.round):
                        continue
                    state.load(r)
                    state.advance(r, bins)
                    state.save(r)
                    if not train:
                        errors[r.model] = errors.get(r.model, 0.0) + np.array([((y - state.pred) ** 2).sum(), n])
                        continue
                    got = histograms(bins, _target(y, state.pred, r.round), state.node, block_rows(block, n, r.given, r.round),
                                     r.start, r.width)
                    if r.model in sums:
                        for a, b in zip(sums[r.model], got):
                            a += b
                    else:
                        sums[r.model] = list(got)
        for model, e in errors.items():
            yield _part(model, -1, e)
        for model, (hist, squares) in sums.items():
            cube = hist.reshape(f, 2, len(squares), BINS)
            for k in range(0, len(squares), CHUNK_NODES):
                yield _part(model, k, np.concatenate([cube[:, :, k:k + CHUNK_NODES].ravel(), squares[k:k + CHUNK_NODES]]))
    return run


def _part(model: int, chunk: int, data: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([model], pa.int32()), pa.array([chunk], pa.int32()), pa.array([data.tobytes()], pa.binary())], schema=_PART)


def _choose(requests: list[Request], n_features: int):
    """Of (model, chunk, data) rows of ``_parts``: added up, and the splits where all histograms of a node have met."""
    by_model = {r.model: r._replace(tree=None, recent=[], older=[]) for r in requests}

    def run(parts: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray]]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for model, chunk, x in parts:
            sums[model, chunk] = sums[model, chunk] + x if (model, chunk) in sums else x
        for (model, chunk), x in sums.items():
            r = by_model[model]
            if chunk >= 0:
                nodes = min(CHUNK_NODES, r.width - chunk)
                hist = x[:-nodes].reshape(n_features, 2, nodes * BINS)
                x = best_splits(hist, x[-nodes:], r.given, r.round, r.start, chunk, r.width)
            yield model, chunk, x
    return run


def _choose_in_arrow(requests: list[Request], n_features: int):
    choose = _choose(requests, n_features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((m, k, np.frombuffer(x.as_buffer())) for b in batches
                 for m, k, x in zip(b.column("model").to_pylist(), b.column("chunk").to_pylist(), b.column("data")))
        for model, chunk, x in choose(parts):
            yield _part(model, chunk, x)
    return run


def _met(parts: DataFrame, requests: list[Request], n_features: int, tasks: int) -> dict[int, dict[int, np.ndarray]]:
    """Per model, its splits by first node and its validation error (-1).  Few bytes meet on the driver, many by key."""
    keys = sum(1 + math.ceil(r.width / CHUNK_NODES) for r in requests)
    size = tasks * sum(r.width for r in requests) * (n_features * 2 * BINS + 1) * 8
    if size <= SMALL_BYTES:
        rows = _choose(requests, n_features)((r["model"], r["chunk"], np.frombuffer(r["data"])) for r in parts.collect())
    else:
        by_key = parts.repartition(min(keys, max(16, 2 * parts.sparkSession.sparkContext.defaultParallelism)), "model", "chunk")
        rows = ((r["model"], r["chunk"], np.frombuffer(r["data"], np.float64 if r["chunk"] < 0 else _BEST))
                for r in by_key.mapInArrow(_choose_in_arrow(requests, n_features), parts.schema).collect())
    found: dict[int, dict[int, np.ndarray]] = {}
    for model, chunk, x in rows:
        found.setdefault(model, {})[chunk] = x
    return found


def _hold(sc, have: list, b: Booster) -> int:
    """Broadcast the trees that most blocks know by now, in parts that double; the first tree that is not among them."""
    since = sum(have[-1][:2]) if have else 0
    while b.round - since >= 2 * RECENT:
        first, count = since, RECENT
        while have and have[-1][1] == count:
            first, _, held = have.pop()
            held.destroy()
            count *= 2
        have.append((first, count, sc.broadcast([t.slim() for t in b.trees[first:first + count]])))
        since = first + count
    return since


def _level_by_level(data: Data, boosters: list[Booster]) -> list[Booster]:
    spark = data.blocks.sparkSession
    sc = spark.sparkContext
    name = f"boosting-{uuid.uuid4().hex[:12]}"
    waiting, slots = list(reversed(boosters)), {}
    older: dict[int, list] = {b.number: [] for b in boosters}
    blocks = data.blocks
    tasks = blocks.rdd.getNumPartitions()
    try:
        while waiting or slots:
            for slot in range(SLOTS):
                if slot not in slots and waiting:
                    slots[slot] = waiting.pop()
            requests = []
            for slot, b in slots.items():
                have = older[b.number]
                since = _hold(sc, have, b)
                requests.append(Request(slot, b.number, b.given, b.round, b.level, b.start, b.width, b.tree.slim(),
                                        [t.slim() for t in b.trees[since:]], since, list(have)))
            parts = blocks.mapInArrow(_parts(requests, name), "model int, chunk int, data binary")
            found = _met(parts, requests, data.n_features, tasks)
            for slot, b in list(slots.items()):
                got = found[b.number]
                if -1 in got:
                    b.scored(*got.pop(-1))
                if not b.done:
                    b.split(np.concatenate([got[k] for k in sorted(got)]))
                if b.done:
                    del slots[slot]
                    for *_, held in older.pop(b.number):
                        held.destroy()
                    if not b.keep:
                        b.trees = []
    finally:
        for have in older.values():
            for *_, held in have:
                held.destroy()
        n = sc.defaultParallelism
        sc.parallelize(range(n), n).foreach(lambda _: shutil.rmtree(os.path.join(SparkFiles.getRootDirectory(), name), ignore_errors=True))
    return boosters


def boost(data: Data, settings: Sequence[Setting], keep: bool = True) -> list[Booster]:
    """Grow a model per setting.  With validation rows, each ends after its patience, and ``best`` is its best round;
    without, each runs all its rounds.  ``keep``: hold on to the trees, not only to the errors."""
    boosters = [Booster(i, s, data.n_features, data.val_rows > 0, keep) for i, s in enumerate(settings)]
    if data.train_rows + data.val_rows <= LOCAL_ROWS:
        return _in_tasks(data, boosters)
    return _level_by_level(data, boosters)


# ------------------------------------------------------------------ Spark model

def _metadata(version: str, cls: str, uid: str, params: dict, **extra) -> str:
    return json.dumps({"class": f"org.apache.spark.ml.regression.{cls}", "timestamp": int(time.time() * 1000), "uid": uid,
                       "sparkVersion": version, "paramMap": params, "defaultParamMap": {}} | extra)


def spark_model(spark: SparkSession, booster: Booster, splits: list[np.ndarray], features_col: str, label: str) -> GBTRegressionModel:
    """The trees up to the best round as Spark ML's model, through its file format."""
    trees, s = booster.trees[:booster.best], booster.given
    path = scratch_dir(spark, "boosted")
    tree_params = {"featuresCol": features_col, "labelCol": label, "maxDepth": s.depth, "maxBins": BINS, "seed": s.seed,
                   "minInstancesPerNode": s.min_rows, "impurity": "variance"}
    params = tree_params | {"maxIter": s.rounds, "stepSize": s.step, "subsamplingRate": s.sample, "featureSubsetStrategy": str(s.features)}
    top = _metadata(spark.version, "GBTRegressionModel", f"BoostedTrees_{uuid.uuid4().hex[:12]}", params, numFeatures=len(splits), numTrees=len(trees))
    spark.createDataFrame([(top,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(i, _metadata(spark.version, "DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", tree_params), booster.weight(i))
                           for i in range(len(trees))], "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    rows = []
    for i, t in enumerate(trees):
        st = t.stats
        for k in range(len(t.left)):
            f, n, total, ss = int(t.feature[k]), float(st["n"][k]), float(st["s"][k]), float(st["ss"][k])
            # the variance of a leaf of the last level is not known (NaN): no histogram is made of it
            impurity = ss / n - (total / n) ** 2 if n else 0.0
            down = (int(t.left[k]), int(t.left[k]) + 1, (f, [float(splits[f][t.cut[k]])], -1)) if f >= 0 else (-1, -1, (-1, [], -1))
            rows.append((i, (k, float(t.value[k]), impurity, [n, total, ss], int(n), float(st["gain"][k]), *down)))
    spark.createDataFrame(rows, "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
                                "rawCount long, gain double, leftChild int, rightChild int, split struct<featureIndex int, "
                                "leftCategoriesOrThreshold array<double>, numCategories int>>").write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)


class BoostedTrees(Estimator):
    """The booster as a stage behind an assembler of ``feats``: fits a ``GBTRegressionModel``.  Rows with
    ``validation_col`` decide when to stop."""

    def __init__(self, feats: Sequence[str], features_col: str, label: str, validation_col: str | None = None, seed: int = 42, **params):
        super().__init__()
        self.feats, self.features_col, self.label, self.validation_col = list(feats), features_col, label, validation_col
        self.given = setting(len(self.feats), seed, **params)

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        flag = self.validation_col
        rows = dataset if flag else dataset.withColumn("__held_out", F.lit(False))
        data = prepare(rows, self.feats, self.label, flag or "__held_out")
        return spark_model(dataset.sparkSession, boost(data, [self.given])[0], data.splits, self.features_col, self.label)
