"""Quality classifier: perplexity under a Kneser-Ney model of trusted text (operator 10).

Two interpolated modified Kneser-Ney models over UTF-8 bytes (order 5) are
trained on a bounded sample of labelled documents, one on trusted text (quality
1, toxic 0; two thirds of ``max_trusted``), one on toxic text (``max_toxic``).
Every language has an equal share of a sample, or all its rows if it has fewer,
those of the smallest hash.  A third of the trusted documents, by hash, is never
trained on.  All trusted documents that were not trained on, whatever their
number, calibrate the thresholds.

A document is rejected if
- its perplexity per byte under the trusted model is above its language's
  ``quantile`` among the calibration documents, times 1 + ``margin`` / sqrt(bytes)
  (the mean over a short text varies more); or
- one of its words is far likelier under the toxic model than under the trusted
  one: the largest sum of log-ratios over a word is above its language's
  ``toxic_quantile``, plus ``toxic_margin`` (in powers of ten).
No language is judged by another's threshold.  Where a language has fewer than
``least`` calibration documents, their quantile is the upper prediction bound of
Student's t (of the log perplexity, of the toxic word), which is wide for few
documents; a language with fewer than two has no threshold and is kept.

*Sharded count joins.*  Each document partition sends its distinct 5-grams,
packed, to the shard of their third and fourth byte.  The model's 5-gram counts
go to the same shards; everything that a probability needs of orders 5, 4 and 3
(counts, continuation counts, context sums) lies in that shard, and orders 2
and 1 are a table of 65,536 entries.  The shard answers with both
log-probabilities per 5-gram; the partition then adds them up per document.
All documents and all their bytes are scored.

Null or empty text: perplexity 1, kept (nothing speaks against it).  Null lang:
a language of its own.  Repeated rows are scored each.  No labels: everything is
kept.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.kn_lm import _discounts, _runs
from wattlake.llm.textvec import SPACE_WORDS, U64, chunks, mix

ORDER = 5
#: Bytes of text that are cut into 5-grams together; arrays of 8 bytes for each stand side by side.
CHUNK = 1 << 19
TRUSTED, TOXIC = 0, 2
_PAD = b"\n" * (ORDER - 1)


def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(5-gram ending at every byte, the byte, offsets); a text starts after line feeds."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    off = np.concatenate([[0], np.cumsum(lens)])
    b = np.frombuffer(_PAD + _PAD.join(texts), np.uint8)
    if not off[-1]:
        return np.zeros(0, U64), np.zeros(0, np.uint8), off
    wide = b.astype(U64)
    k = np.zeros(len(b) - ORDER + 1, U64)
    for j in range(ORDER):
        k = (k << U64(8)) | wide[j:j + len(k)]
    inside = np.ones(len(k), bool)  # drop the padding between texts
    for j in range(ORDER - 1):
        at = off[1:-1] + (ORDER - 1) * np.arange(len(texts) - 1) + j
        inside[at] = False
    return k[inside], b[ORDER - 1:][inside], off


def _merge(keys: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, U64)


def _shard(keys: np.ndarray, n: int) -> np.ndarray:
    """By the third and fourth byte, which all orders from 3 up share."""
    return (mix((keys >> U64(8)) & U64(0xFFFF)) % U64(n)).astype(np.int64)


def _count_training(batches, part_of: dict) -> Iterator[pa.RecordBatch]:
    """5-grams of the sampled documents: (key, trusted count, toxic count)."""
    for cols in chunks(batches, "text", CHUNK):
        out = []
        for part in (TRUSTED, TOXIC):
            texts = [t for t, d in zip(cols["text"], cols["doc_id"]) if t and part_of.get(d) == part]
            k, n = np.unique(keys_of(texts)[0], return_counts=True) if texts else (np.zeros(0, U64), np.zeros(0, np.int64))
            out.append((k, n if part == TRUSTED else 0 * n, n if part == TOXIC else 0 * n))
        k, a, b = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(a), pa.array(b)], names=["key", "a", "b"])


def _send_grams(batches, n_shards: int, store: str) -> Iterator[pa.RecordBatch]:
    """The partition's distinct 5-grams, to a side file and to their shards."""
    pid, keys = ex.pid(), [np.zeros(0, U64)]
    for cols in chunks(batches, "text", CHUNK):
        keys.append(np.unique(keys_of([t for t in cols["text"] if t])[0]))
        if sum(map(len, keys[1:])) > max(1 << 20, len(keys[0])):
            keys = [_merge(keys)]
    k = _merge(keys)
    order, bounds = ex.by_shard(_shard(k, n_shards), n_shards)
    st.put_arrays(store, f"grams/{pid}", key=k)
    k = k[order]
    full = [s for s in range(n_shards) if bounds[s + 1] > bounds[s]]
    yield ex.rows(full, pid, 0, [ex.pack(k[bounds[s]:bounds[s + 1]], ORDER) for s in full])


def _send_model(batches, n_shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k, a, b = (batch.column(i).to_numpy() for i in range(3))
        order, bounds = ex.by_shard(_shard(k.view(U64), n_shards), n_shards)
        k, a, b = k[order], a[order], b[order]
        full = [s for s in range(n_shards) if bounds[s + 1] > bounds[s]]
        yield ex.rows(full, -1, 0, [np.stack([x[bounds[s]:bounds[s + 1]] for x in (k, a, b)]).tobytes() for s in full])


class _Table:
    """Sorted keys with counts; lookups give 0 for unknown keys."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = _runs(keys)
        self.keys = keys[first]
        self.n = np.add.reduceat(n[order], first) if len(keys) else n

    def get(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.n[at], 0)


def _orders(keys: np.ndarray, n: np.ndarray, lowest: int) -> dict[int, _Table]:
    """Counts of order 5 and continuation counts (distinct left extensions) of the lower orders."""
    out = {ORDER: _Table(keys[n > 0], n[n > 0])}
    for k in range(ORDER - 1, lowest - 1, -1):
        above = out[k + 1].keys & U64((1 << 8 * k) - 1)
        out[k] = _Table(above, np.ones(len(above), np.int64))
    return out


def _interpolate(tables: dict[int, _Table], keys: np.ndarray, low: np.ndarray, lowest: int, discounts: dict) -> np.ndarray:
    """P of every 5-gram's last byte; ``low`` is the probability of the order below ``lowest``."""
    p = low
    for k in range(lowest, ORDER + 1):
        t, d = tables[k], np.array(discounts[k])
        gram = keys & U64((1 << 8 * k) - 1)
        ctx = t.keys >> U64(8)
        one = np.ones(len(ctx), np.int64)
        want = gram >> U64(8)
        total = _Table(ctx, t.n).get(want)
        gap = sum(d[j] * _Table(ctx, one * ((t.n == j) if j < 3 else (t.n > 2))).get(want) for j in (1, 2, 3))
        c = t.get(gram)
        seen = total > 0
        p = np.where(seen, (np.maximum(c - d[np.minimum(c, 3)], 0) + gap * p) / np.maximum(total, 1), p)
    return p


def _answer(model: list[bytes], blocks: list[bytes], low: np.ndarray, discounts: list[dict]) -> list[bytes]:
    """log10 probabilities (trusted, toxic) of every 5-gram of every block."""
    parts = [np.frombuffer(m, np.int64).reshape(3, -1) for m in model]
    k, a, b = np.concatenate(parts, 1) if parts else np.zeros((3, 0), np.int64)
    keys = [ex.unpack(x, ORDER) for x in blocks]
    wanted, back = np.unique(np.concatenate(keys), return_inverse=True)
    out = np.empty((len(wanted), 2), np.float32)
    for i, n in enumerate((a, b)):
        tables = _orders(np.ascontiguousarray(k).view(U64), np.ascontiguousarray(n), 3)
        p = _interpolate(tables, wanted, low[i][(wanted & U64(0xFFFF)).astype(np.int64)], 3, discounts[i])
        out[:, i] = np.log10(p)
    out = out[back]
    cuts = np.cumsum([len(x) for x in keys])[:-1]
    return [np.ascontiguousarray(x).tobytes() for x in np.split(out, cuts)]


def _low_orders(c5: DataFrame, col: str) -> tuple[np.ndarray, dict]:
    """P of order 2 for all byte pairs, and the discounts of every order.

    Order k's table is the distinct grams of order k + 1 counted by suffix; the
    driver gets counts of counts and the byte pairs only.
    """
    t = c5.where(F.col(col) > 0).select("key", F.col(col).alias("n"))
    discounts, pairs = {}, np.zeros((256, 256), np.int64)
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            t = t.groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("key")).agg(F.count("*").alias("n"))
        cc = t.agg(*(F.count_if(F.col("n") == j).alias(f"n{j}") for j in (1, 2, 3, 4))).first()
        discounts[k] = _discounts(*cc).tolist()
        if k == 2:  # at most 65,536 rows
            for r in t.collect():
                pairs[r["key"] >> 8, r["key"] & 255] = r["n"]
    d1, d2 = np.array(discounts[1]), np.array(discounts[2])
    c1 = (pairs > 0).sum(0)
    total = max(1, c1.sum())
    p1 = np.maximum(c1 - d1[np.minimum(c1, 3)], 0) / total + (d1[np.minimum(c1, 3)] * (c1 > 0)).sum() / total / 256
    if not c1.any():
        p1 = np.full(256, 1 / 256)
    row = pairs.sum(1, keepdims=True)
    gap = sum(d2[j] * ((pairs == j) if j < 3 else (pairs > 2)).sum(1, keepdims=True) for j in (1, 2, 3))
    p2 = (np.maximum(pairs - d2[np.minimum(pairs, 3)], 0) + gap * p1) / np.maximum(row, 1)
    return np.where(row > 0, p2, np.broadcast_to(p1, (256, 256))).ravel(), discounts


def _score(batches, store: str, n_shards: int, part_of: dict) -> Iterator[pa.RecordBatch]:
    pid, base = ex.pid(), 0
    known = np.asarray(st.map_array(store, f"grams/{pid}", "key"))
    order, _ = ex.by_shard(_shard(known, n_shards), n_shards)
    parts = ex.Answers(store, "logp", pid).parts.pop(0, {})
    logp = np.empty((len(known), 2), np.float32)
    logp[order] = np.frombuffer(b"".join(parts[s] for s in sorted(parts)), np.float32).reshape(-1, 2)
    ratio = logp[:, 1] - logp[:, 0]
    trusted = np.ascontiguousarray(logp[:, 0])
    for cols in chunks(batches, "text", CHUNK):
        texts = [t or b"" for t in cols["text"]]
        n = len(texts)
        keys, last, off = keys_of(texts)
        size = np.diff(off)
        full = np.flatnonzero(size)
        mean, toxic = np.zeros(n), np.zeros(n)
        if len(keys):
            at = np.searchsorted(known, keys)
            mean[full] = np.add.reduceat(trusted[at].astype(np.float64), off[full]) / size[full]
            # words end where white space or a new text follows; the space counts to the word before it
            space = ~SPACE_WORDS[last]
            starts = np.concatenate([[True], space[:-1]])
            starts[off[full]] = True
            first = np.flatnonzero(starts)
            words = np.add.reduceat(ratio[at].astype(np.float64), first)
            toxic[full] = np.maximum.reduceat(words, np.searchsorted(first, off[full]))
        yield pa.RecordBatch.from_pydict({
            "ref": pa.array((pid << ex.REF_BITS) + base + np.arange(n)), "doc_id": pa.array(cols["doc_id"], pa.int64()),
            "lang": pa.array(cols["lang"], pa.string()), "n_bytes": pa.array(size),
            "perplexity": pa.array(10.0 ** -mean), "toxic_word": pa.array(toxic),
            "part": pa.array([part_of.get(d, -1) for d in cols["doc_id"]], pa.int32())})
        base += n


def _drawn(rows: DataFrame, n: int) -> list[int]:
    """doc_ids of at most n of ``rows`` (distinct doc_id, l), an equal share of each language, of the smallest hash."""
    sizes = sorted(((r["n"], r["l"]) for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()))  # languages are few
    take, left = {}, n
    for i, (size, lang) in enumerate(sizes):
        take[lang] = min(size, max(1, left // (len(sizes) - i)))
        left -= take[lang]
    if not take:
        return []
    # about twice the share passes, and is cut after the order by hash
    most = rows.sparkSession.createDataFrame(
        [(lang, int(min(1.0, (2 * take[lang] + 64) / size) * (1 << 30))) for size, lang in sizes], "l string, most long")
    got: dict[str, list] = {lang: [] for lang in take}
    h = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 30))
    for r in rows.withColumn("h", h).join(F.broadcast(most), "l").where("h < most").select("l", "h", "doc_id").collect():
        got[r["l"]].append((r["h"], r["doc_id"]))
    return [d for lang, found in got.items() for _, d in sorted(found)[:take[lang]]]


def _labelled(src: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, q, t, l) of every labelled document; l is empty for a null language."""
    label = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    own = src.where("doc_id is not null").groupBy("doc_id").agg(F.max(lang).alias("l"))
    return own.join(label, "doc_id")


def _sample(labelled: DataFrame, max_trusted: int, max_toxic: int) -> dict:
    """doc_id -> part of the bounded sample that is trained on."""
    out = dict.fromkeys(_drawn(labelled.where("q = 1 and t = 0 and pmod(xxhash64(doc_id), 3) != 2"), 2 * max_trusted // 3), TRUSTED)
    out.update(dict.fromkeys(_drawn(labelled.where("t = 1"), max_toxic), TOXIC))
    return out


def _student(df: int, quantile: float) -> float:
    """Quantile (above one half) of Student's t: with t = sqrt(df) tan(a) the density is proportional to cos(a) ** (df - 1)."""
    a = np.linspace(0, np.pi / 2, 100_001)
    area = np.cumsum(np.cos(a) ** (df - 1))
    return float(np.sqrt(df) * np.tan(a[np.searchsorted(area, (2 * quantile - 1) * area[-1])]))


def _bound(mean: str, sd: str, quantile: float, least: int) -> Column:
    """Upper prediction bound from n = 2 to ``least`` - 1 values; null for fewer."""
    k = [(n, _student(n - 1, quantile) * (1 + 1 / n) ** 0.5) for n in range(2, max(3, least))]
    return F.col(mean) + F.col(sd) * F.create_map(*(F.lit(x) for pair in k for x in pair))[F.col("n").cast("int")]


def classify(docs: DataFrame, labels: DataFrame, max_trusted: int = 24000, max_toxic: int = 8000,
             quantile: float = 0.99, margin: float = 3.0, toxic_quantile: float = 0.99, toxic_margin: float = 1.0,
             least: int = 50) -> tuple[DataFrame, DataFrame, str]:
    """(scores, plain scan of ``docs``, store): per row ref, doc_id, lang, n_bytes, perplexity, threshold,
    toxic_word, toxic_threshold, keep."""
    spark = docs.sparkSession
    store = st.new_store(spark, "quality")
    scan = st.scanned(docs, store)
    src = scan.select("doc_id", "lang", F.col("text").cast("binary").alias("text"))
    n_pids, n_shards = max(1, src.rdd.getNumPartitions()), st.shards_of(src)
    labelled = st.saved(_labelled(src, labels), store, "labelled")
    part_of = _sample(labelled, max_trusted, max_toxic)
    # the sample's ids are bounded by the two parameters
    ids = spark.createDataFrame([(d,) for d in part_of], "doc_id long")
    sampled = src.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")
    c5 = st.saved(sampled.mapInArrow(partial(_count_training, part_of=part_of), "key long, a long, b long")
                  .groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), store, "c5")
    (low_a, d_a), (low_b, d_b) = _low_orders(c5, "a"), _low_orders(c5, "b")
    blocks = src.select("text").mapInArrow(partial(_send_grams, n_shards=n_shards, store=store), ex.BLOCK_SCHEMA)
    model = c5.mapInArrow(partial(_send_model, n_shards=n_shards), ex.BLOCK_SCHEMA)
    ex.answered(blocks.union(model), partial(_answer, low=np.stack([low_a, low_b]), discounts=[d_a, d_b]),
                n_shards, n_pids, store, "logp", given=True)
    scored = st.saved(src.mapInArrow(
        partial(_score, store=store, n_shards=n_shards, part_of=part_of),
        "ref long, doc_id long, lang string, n_bytes long, perplexity double, toxic_word double, part int"), store, "scored")
    trusted = labelled.where("q = 1 and t = 0").select("doc_id")
    calibration = scored.where("part = -1").join(trusted, "doc_id", "left_semi").withColumn("log", F.log("perplexity"))
    by = calibration.groupBy(F.col("lang").alias("l")).agg(
        F.count("*").alias("n"), F.percentile_approx("perplexity", quantile, 10000).alias("p"),
        F.percentile_approx("toxic_word", toxic_quantile, 10000).alias("t"),
        *(f(c).alias(f"{c}_{f.__name__}") for c in ("log", "toxic_word") for f in (F.avg, F.stddev_samp)))
    few = F.col("n") < least
    by = by.select("l", F.when(few, F.exp(_bound("log_avg", "log_stddev_samp", quantile, least))).otherwise(F.col("p")).alias("p"),
                   F.when(few, _bound("toxic_word_avg", "toxic_word_stddev_samp", toxic_quantile, least)).otherwise(F.col("t")).alias("t"))
    top = F.lit(float("inf"))
    out = (scored.join(by, F.expr("lang <=> l"), "left")
           .withColumn("threshold", F.col("p") * (1 + margin / F.sqrt(F.greatest("n_bytes", F.lit(1)))))
           .withColumn("toxic_threshold", F.when(F.col("t").isNotNull(), F.greatest("t", F.lit(0.0)) + toxic_margin))
           .withColumn("keep", (F.col("perplexity") <= F.coalesce("threshold", top))
                       & (F.col("toxic_word") <= F.coalesce("toxic_threshold", top)))
           .select("ref", "doc_id", "lang", "n_bytes", "perplexity", "threshold", "toxic_word", "toxic_threshold", "keep"))
    return out, scan, store
