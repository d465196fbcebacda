"""Nearest neighbours by inner product with an adaptive dimension scan (operator 8).

*Index.*  Vectors fall into length classes, one per power of two; a vector of class e
is scaled by 2^-e, to a length between 1/2 and 1, and gets one more component,
sqrt(1 - |x|^2) (0 for a query, which is scaled to length 1).  Inside a class that turns
the largest inner product into the smallest distance; one very long vector changes only
its own class, and no square overflows.  Vectors are rotated at random.  Inverted lists
are k-means cells of one class, whose centroids are fitted on a bounded sample
(``max_fit`` vectors of smallest hash); every vector is put into its list.  Classes that
the sample does not have share one list that every query scans whole.  A long list is
dealt over blocks of ``block_rows`` vectors, so copies of one vector do not meet in one
task.

*Search.*  A query is sent to the blocks of its nearest lists: ``probe`` of each class's
lists, and as many more as hold ``spare`` times k vectors.  A block scans its
rotated vectors in column blocks.  After d of D dimensions a candidate is
abandoned if its partial squared distance, scaled by D / d, is above
(1 + ``eps`` / sqrt(d))^2 times the squared distance of the k-th candidate known
so far: under the hypothesis that it belongs to the k nearest, random rotation
makes that very unlikely.  Survivors are scored exactly, in double precision, on
the original vectors.

Nulls, zero vectors and vectors with null or non-finite components take no
part, nor do rows with a null vec_id or vectors of another length than the most
frequent one.  Equal scores: the smaller vec_id.  Every row is a candidate, and every row
whose vec_id is a query's is a query of its own: a repeated vec_id has k results per row,
and its other rows are candidates like any.  Scores are plain double precision products
(infinite beyond its range).  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm import store as st

OUT = "query_row long, query_id long, vec_id long, score double"
_ROWS = "bucket long, is_query boolean, row long, vec_id long, x binary"


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten(),
                      dtype=np.float64).reshape(-1, dims)


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths, also where the squares overflow."""
    top = np.abs(x).max(1, keepdims=True)
    return top[:, 0] * np.sqrt(((x / top) ** 2).sum(1))


class Index:
    """Rotation, centroids and the length class of each list: small, sent to every task."""

    def __init__(self, dims: int, centroids: np.ndarray, classes: np.ndarray, rotation: np.ndarray):
        self.dims, self.centroids, self.classes, self.rotation = dims, centroids, classes, rotation

    @property
    def rest(self) -> int:
        """The list of the classes without centroids."""
        return len(self.centroids)

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        n = lengths(x)
        if query:
            y, more = x / n[:, None], np.zeros(len(x))
        else:
            y = np.ldexp(x, -np.frexp(n)[1][:, None])
            more = np.sqrt(np.maximum(1 - (y * y).sum(1), 0))
        return (np.concatenate([y, more[:, None]], 1) @ self.rotation).astype(np.float32)

    def far(self, y: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, up to a term that is equal for all of a row."""
        return (self.centroids * self.centroids).sum(1) - 2 * y @ self.centroids.T

    def own(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector: the nearest of its class, or the rest."""
        out = np.full(len(x), self.rest, np.int64)
        e = np.frexp(lengths(x))[1]
        for c in np.unique(self.classes):
            at, lists = np.flatnonzero(e == c), np.flatnonzero(self.classes == c)
            for i in range(0, len(at), 8192):
                part = at[i:i + 8192]
                out[part] = lists[np.argmin(self.far(self.turned(x[part], False))[:, lists], 1)]
        return out


def _cells(y: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """k-means centroids."""
    centroids = y[rng.permutation(len(y))[:lists]].copy()
    for _ in range(rounds):
        term = (centroids * centroids).sum(1)
        own = np.concatenate([np.argmin(term - 2 * y[i:i + 8192] @ centroids.T, 1) for i in range(0, len(y), 8192)])
        n = np.bincount(own, minlength=len(centroids))
        total = np.stack([np.bincount(own, y[:, j], len(n)) for j in range(y.shape[1])], 1)
        centroids = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centroids).astype(np.float32)
    return centroids


def _fit(x: np.ndarray, lists: int, seed: int = 7) -> Index:
    """Lists for the classes of the sample, shared out by their rows."""
    dims = x.shape[1]
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dims + 1, dims + 1)))[0]
    index = Index(dims, np.zeros((0, dims + 1), np.float32), np.zeros(0, np.int64), rotation)
    e = np.frexp(lengths(x))[1]
    parts = {int(c): _cells(index.turned(x[e == c], False), max(1, round(lists * float((e == c).mean()))), rng) for c in np.unique(e)}
    index.centroids = np.concatenate(list(parts.values()))
    index.classes = np.repeat(list(parts), [len(p) for p in parts.values()])
    return index


def _assign(batches, index: Index) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            x = _matrix(b.column(1), index.dims)
            yield pa.RecordBatch.from_pydict({"list": index.own(x), "vec_id": b.column(0),
                                              "x": pa.array([r.tobytes() for r in x], pa.binary())})


def _probe(batches, index: Index, sizes: np.ndarray, blocks: np.ndarray, probe: float, enough: int, width: int
           ) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        raw = np.array(b.column(2).to_pylist(), object)
        x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, index.dims)
        far = index.far(index.turned(x, True))
        use = np.zeros((len(x), len(sizes)), bool)
        use[:, index.rest] = True
        for c in np.unique(index.classes):
            lists = np.flatnonzero((index.classes == c) & (sizes[:-1] > 0))
            order = lists[np.argsort(far[:, lists], 1, kind="stable")]
            held = np.cumsum(sizes[order], 1) - sizes[order]
            take = (np.arange(order.shape[1]) < max(1, round(probe * len(lists)))) | (held < enough)
            use[np.nonzero(take)[0], order[take]] = True
        row, lists = np.nonzero(use & (sizes > 0))
        n = blocks[lists]
        row, lists = np.repeat(row, n), np.repeat(lists, n)
        block = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_pydict({
            "bucket": lists * width + block, "is_query": np.ones(len(row), bool), "row": b.column(0).to_numpy()[row],
            "vec_id": b.column(1).to_numpy()[row], "x": pa.array(raw[row].tolist(), pa.binary())})


def column_blocks(dims: int) -> list[tuple[int, int]]:
    """16, 16, 32, 64, ... columns."""
    out, at = [], 0
    while at < dims:
        out.append((at, min(dims, max(16, 2 * at))))
        at = out[-1][1]
    return out


def adaptive_scan(q: np.ndarray, x: np.ndarray, k: int, eps: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, candidate) pairs that survive, and the number of components read; rotated vectors.

    While many pairs are left, a column block is one matrix product over all of
    them; later only the pairs left are read.
    """
    dims = x.shape[1]
    part = np.zeros((len(q), len(x)), np.float32)
    alive = np.ones(part.shape, bool)
    pairs, read, bound = None, 0, np.full(len(q), np.inf, np.float32)
    for lo, hi in column_blocks(dims):
        if pairs is None:
            a, b = q[:, lo:hi], x[:, lo:hi]
            part += (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
            read += part.size * (hi - lo)
        else:
            part[pairs] += ((x[pairs[1], lo:hi] - q[pairs[0], lo:hi]) ** 2).sum(1)
            read += len(pairs[0]) * (hi - lo)
        if len(x) <= k:
            continue
        if hi < dims:
            # the k candidates that look nearest so far bound the distance of the k-th
            best = np.argpartition(part, k - 1, 1)[:, :k]
            far = ((x[best] - q[:, None, :]) ** 2).sum(2).max(1) * np.float32(1 + 1e-4)
            read += best.size * dims
            bound = np.minimum(bound, far)
            limit = bound * np.float32((1 + eps / np.sqrt(hi)) ** 2 * hi / dims)
        else:
            limit = bound
        alive &= part <= limit[:, None]
        part[~alive] = np.inf
        if hi < dims and alive.mean() < 0.1:
            pairs = np.nonzero(alive)
    a, b = np.nonzero(alive)
    return a, b, read


def _search(batches, index: Index, k: int, eps: float, width: int) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    t = pa.Table.from_batches(parts)
    bucket, is_query = t.column("bucket").to_numpy(), t.column("is_query").to_numpy()
    rows, ids, raw = t.column("row").to_numpy(), t.column("vec_id").to_numpy(), t.column("x")
    order = np.lexsort((is_query, bucket))
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) > 0, [True]]))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        at = order[lo:hi]
        n = int((~is_query[at]).sum())
        if not n or n == len(at):
            continue
        x = np.frombuffer(b"".join(raw.take(pa.array(at)).to_pylist()), np.float64).reshape(-1, index.dims)
        cand, row, own = x[:n], rows[at[:n]], ids[at[:n]]
        whole = bucket[at[0]] // width == index.rest
        y = None if whole else index.turned(cand, False)
        step = max(1, (1 << 22) // max(n, 1))
        for i in range(n, len(at), step):
            q, who, asker = x[i:i + step], ids[at[i:i + step]], rows[at[i:i + step]]
            if whole:
                a, b = np.divmod(np.arange(len(q) * n), n)
            else:
                a, b, _ = adaptive_scan(index.turned(q, True), y, k + 1, eps)  # one more: the query's own row
            other = row[b] != asker[a]
            a, b = a[other], b[other]
            score = np.empty(len(a))
            for j in range(0, len(a), 1 << 16):
                s = slice(j, j + (1 << 16))
                with np.errstate(over="ignore", invalid="ignore"):
                    score[s] = (cand[b[s]] * q[a[s]]).sum(1)
            best = np.lexsort((own[b], -score, a))
            rank = np.arange(len(best)) - np.searchsorted(a[best], a[best])
            best = best[rank < k]
            yield pa.RecordBatch.from_pydict({"query_row": asker[a[best]], "query_id": who[a[best]], "vec_id": own[b[best]],
                                              "score": score[best]})


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, max_fit: int = 32768, probe: float = 0.75, spare: int = 50,
            eps: float = 1.2, block_rows: int = 4096, max_lists: int = 4096) -> DataFrame:
    """Per query row (vec_id divisible by ``every``) its k nearest: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    store = st.new_store(spark, "ann")
    doubles = F.transform("embedding", lambda v: v.cast("double"))
    valid = (vectors.where("vec_id is not null and embedding is not null").select("vec_id", doubles.alias("e"))
             .where(F.size("e") > 0).where(~F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
             .where(F.exists("e", lambda v: v != 0)).withColumn("n", F.size("e")))
    common = valid.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, total = common["n"], common["c"]
    valid = valid.where(F.col("n") == dims).select("vec_id", "e")
    # a bounded sample: max_fit rows of smallest hash
    fit = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max_fit).select("e").toArrow()
    lists = int(min(max_lists, max(1, round(total ** 0.5))))
    index = _fit(_matrix(fit.column(0), dims), lists)
    placed = st.saved(valid.mapInArrow(partial(_assign, index=index), "list long, vec_id long, x binary")
                      .withColumn("row", F.monotonically_increasing_id()), store, "placed")
    sizes = np.zeros(len(index.centroids) + 1, np.int64)
    for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect():  # one row per list
        sizes[r["list"]] = r["n"]
    blocks = np.maximum(1, -(-sizes // block_rows))
    width = int(blocks.max())
    of = F.get(F.lit(blocks.tolist()), F.col("list").cast("int"))
    cand = placed.select((F.col("list") * width + F.pmod(F.xxhash64("row"), of)).alias("bucket"),
                         F.lit(False).alias("is_query"), "row", "vec_id", "x")
    queries = placed.where(F.pmod("vec_id", F.lit(every)) == 0).select("row", "vec_id", "x").mapInArrow(
        partial(_probe, index=index, sizes=sizes, blocks=blocks, probe=probe, enough=spare * k, width=width), _ROWS)
    n = min(st.shards_of(valid) * 4, max(1, int(blocks.sum())))
    found = cand.union(queries).repartition(n, "bucket").mapInArrow(partial(_search, index=index, k=k, eps=eps, width=width), OUT)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
