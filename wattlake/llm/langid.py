"""Language identification by nearest centroid (operator 9).

A text's vector counts its byte trigrams (A-Z in lower case, other ASCII
characters than letters as one space) in ``DIMS`` hash buckets; counts become
1 + ln(count), times ln(N / document frequency), scaled to length 1.  Document
frequencies come from all training documents.  Each language has up to
``clusters`` centroids (spherical k-means), fitted on a bounded sample of
``per_lang`` training documents of each language (``max_sample`` in all), those
of the smallest hash of doc_id and text: null and repeated doc_ids are drawn like
others, equal rows once.  The driver collects the sample only.

A document gets the language of the centroid of the largest cosine, which is its
score.  It is ``rejected`` when it is farther from its centroid than nearly all
of that language's sample (cosine below the sample's ``reject`` quantile times
``slack``); with ``und_if_rejected`` its language is then ``und``.

Null text, or text without a letter: ``und``, score 0.  Training documents with
null lang or null text are left out; no training document at all makes every
document ``und``.  Equal cosines: the language first in code-point order.  Repeated rows
are predicted each; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm import store as st
from wattlake.llm.textvec import chunks

CHUNK = 4 << 20
GROUP = 256
DIMS = 4096

_FOLD = np.full(256, 32, np.uint8)
_FOLD[0x41:0x5B] = _FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def is_training(doc_id, modulo: int, held: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulo != held


def has_letter(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        out[i] = t.isalpha() or any(97 <= c <= 122 for c in t[:64].lower()) or any(
            c.isalpha() for c in t.decode("utf-8", "replace"))
    return out


def counts(texts: list[bytes]) -> np.ndarray:
    """Trigram counts, one row per text."""
    n = len(texts)
    b = _FOLD[np.frombuffer(b"\x00".join(texts) + b"\x00\x00", np.uint8)].astype(np.uint32)
    lens = np.fromiter(map(len, texts), np.int64, n)
    doc = np.repeat(np.arange(n, dtype=np.int32), lens + 1)
    code = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761) >> np.uint32(20)
    # the last two grams of a text run over its end: they hold the separator, a space, and are dropped
    m = min(len(code), len(doc))
    ends = np.cumsum(lens + 1)
    ok = np.ones(m, bool)
    for back in (1, 2):
        at = ends - 1 - back
        at = at[(at >= ends - 1 - lens) & (at < m) & (at >= 0)]
        ok[at] = False
    at = ends - 1
    ok[at[at < m]] = False
    flat = doc[:m][ok].astype(np.int64) * DIMS + code[:m][ok]
    return np.bincount(flat, minlength=n * DIMS).reshape(n, DIMS)


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _frequencies(batches, modulo: int, held: int) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(DIMS, np.int64), 0
    for cols in chunks(batches, "text", CHUNK):
        mine = [t for t, d, lang in zip(cols["text"], cols["doc_id"], cols["lang"])
                if t and lang is not None and is_training(d, modulo, held)]
        for i in range(0, len(mine), GROUP):
            df += (counts(mine[i:i + GROUP]) > 0).sum(0)
        docs += len(mine)
    yield pa.RecordBatch.from_pydict({"bucket": np.arange(-1, DIMS), "n": np.append(docs, df)})


def _once(batches) -> Iterator[pa.RecordBatch]:
    """The first of equal rows (lang, h, text) of a task; few distinct ones arrive."""
    seen: set[tuple] = set()
    for b in batches:
        new = []
        for i, k in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            if k not in seen:
                seen.add(k)
                new.append(i)
        if new:
            yield b.take(pa.array(new))


def _sample_vectors(batches, idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    for cols in chunks(batches, "text", CHUNK):
        for i in range(0, len(cols["text"]), GROUP):
            v = vectors(counts(cols["text"][i:i + GROUP]), idf).astype(np.float16)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(cols["lang"][i:i + GROUP], pa.string()),
                                              "h": pa.array(cols["h"][i:i + GROUP], pa.int64()),
                                              "v": pa.array([x.tobytes() for x in v], pa.binary())})


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from the farthest points."""
    picked = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[picked[0]]
    while len(picked) < min(k, len(x)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picked[-1]])
    c = x[picked]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _predict(batches, idf, centroids, owner, floor, langs, modulo, held, und_if_rejected) -> Iterator[pa.RecordBatch]:
    for cols in chunks(batches, "text", CHUNK):
        for i in range(0, len(cols["text"]), GROUP):
            texts = [t or b"" for t in cols["text"][i:i + GROUP]]
            ids = cols["doc_id"][i:i + GROUP]
            known = has_letter(texts) & bool(len(langs))
            lang, score, out = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if len(langs):
                cos = vectors(counts(texts), idf) @ centroids.T
                best = np.argmax(cos, 1)
                score = np.where(known, np.clip(cos[np.arange(len(texts)), best], 0, 1), 0).astype(float)
                out = known & (score < floor[owner[best]])
                lang = [langs[owner[b]] if k and not (r and und_if_rejected) else "und"
                        for b, k, r in zip(best, known, out)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array([not is_training(d, modulo, held) for d in ids]),
                "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "rejected": pa.array(out)})


def identify(docs: DataFrame, modulo: int = 4, held: int = 2, clusters: int = 4, per_lang: int = 500,
             max_sample: int = 6000, reject: float = 0.01, slack: float = 0.8, und_if_rejected: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id bigint, text string, lang string): doc_id, held_out, lang_pred, score, rejected."""
    spark = docs.sparkSession
    st.ship(spark)
    src = docs.select("doc_id", "lang", F.col("text").cast("binary").alias("text"))
    df = (src.mapInArrow(partial(_frequencies, modulo=modulo, held=held), "bucket long, n long")
          .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # DIMS + 1 rows
    table = {r["bucket"]: r["n"] for r in df}
    total = table.get(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([table.get(i, 0) for i in range(DIMS)]))).astype(np.float32) + np.float32(1e-3)
    training = (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulo)) != held)
    rows = (src.where(training & F.col("lang").isNotNull() & (F.length("text") > 0))
            .withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62))))
    # distinct rows of each language, nearly: repeated ones do not count
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    langs = sorted(sizes)
    centroids, owner, floor = np.zeros((0, DIMS), np.float32), np.zeros(0, np.int64), np.zeros(0)
    if langs:
        each = max(1, min(per_lang, max_sample // len(langs)))
        # about twice `each` distinct rows of a language pass, whatever its size, and are cut after the order by hash
        share = F.create_map(*(F.lit(x) for lang in langs for x in (
            lang, int(min(1.0, (2 * each + 64) / max(1, sizes[lang])) * (1 << 62)))))
        first = Window.partitionBy("lang").orderBy("h")
        sample = (rows.where(F.col("h") < share[F.col("lang")]).select("lang", "h", "text")
                  .mapInArrow(_once, "lang string, h long, text binary").dropDuplicates(["lang", "h"])
                  .withColumn("i", F.row_number().over(first)).where(F.col("i") <= each).select("text", "lang", "h")
                  .mapInArrow(partial(_sample_vectors, idf=idf), "lang string, h long, v binary"))
        held_rows: dict[str, list] = {lang: [] for lang in langs}
        for r in sample.collect():
            held_rows[r["lang"]].append((r["h"], r["v"]))
        cs, own, low = [], [], []
        for i, lang in enumerate(langs):
            x = np.stack([np.frombuffer(v, np.float16).astype(np.float32) for _, v in sorted(held_rows[lang])])
            c = _cluster(x, clusters)
            cs.append(c)
            own += [i] * len(c)
            low.append(slack * float(np.quantile((x @ c.T).max(1), reject)))
        centroids, owner, floor = np.concatenate(cs), np.array(own), np.array(low)
    return src.select("doc_id", "text").mapInArrow(
        partial(_predict, idf=idf, centroids=centroids, owner=owner, floor=floor, langs=langs, modulo=modulo, held=held,
                und_if_rejected=und_if_rejected),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
