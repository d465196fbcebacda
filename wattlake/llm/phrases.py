"""Phrase collocations from weighted acyclic automata (operator 13).

Texts are cut into pieces and words; a phrase is up to three neighbouring words of
one piece, and everything is counted per language.

*Count transducers.*  A task turns the words of a chunk into its sorted distinct
phrases and builds, range by range, the acyclic automaton that maps each phrase to
its count: arcs carry a word and the count of the phrase they complete.  The
states after two words are built from their sorted arcs and registered, so equal
states (the same words with the same counts behind different pairs) are one state.

*Union by prefix range.*  A two-word phrase and all its extensions belong to the
range of the hash of their first two words, a single word to the range of its own
hash; so a frequent word is spread by what follows it, and each chunk sends at
most one arc for a phrase.  A range's task unites the chunks' automata: it sums
the weights of equal paths, and keeps the paths of weight ``least`` and more.  No
phrase that rarer than that can be a candidate or a part of one, so the result, one
automaton per range written to the shared folder, has all that is needed.  Arcs
below a pair that is too rare are not opened at all.

*Composition.*  The first part of a phrase is a prefix of its path.  The rest is
the path of another range: each range asks for its distinct rests and words once,
and the ranges answer by binary search in their automata.  A question carries the
count of the longest candidate behind it, so the asked range also learns which of
its phrases are mostly part of a longer one.  Cuts are scored in exact integers.

A range holds 1 / (shuffle partitions) of the distinct phrases, whatever the
input.  Each range sends its first ``top`` phrases of a language, and two rounds of
ranking join them.

Null text: empty.  Null lang: ``und`` (one group with a literal ``und``).  Repeated
rows count each time.  A text of any length is cut at piece ends into buffers of
``CHUNK`` bytes (a longer piece stays whole).  Empty table: no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm import store as st
from wattlake.llm.textvec import U64, chunks, give_back, mix, words_of

CHUNK = 16 << 20
SCHEMA = "shard int, kind int, source int, lang string, data binary, n long"
_ROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("source", pa.int32()), ("lang", pa.string()),
                  ("data", pa.binary()), ("n", pa.int64())])
COUNTS, AUTOMATON, ASKED, TOTAL, ANSWER, INSIDE = range(6)
RESULT = "shard int, lang string, phrase string, a long, l long, r long, score long"
#: The ends of pieces become line feeds, tabs become spaces.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\x09", b"\n" * 9 + b" ")


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _row(shard: int, kind: int, lang: str, source: int = 0, data: bytes | None = None, n: int = 0) -> tuple:
    return shard, kind, source, lang, data, n


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)


def _by_shard(batches) -> Iterator[tuple[int, dict[str, list[dict]]]]:
    """The rows of a task, shard after shard, by language."""
    rows = (r for b in batches for r in b.to_pylist())
    for shard, part in groupby(rows, key=lambda r: r["shard"]):
        langs: dict[str, list[dict]] = {}
        for r in part:
            langs.setdefault(r["lang"], []).append(r)
        yield shard, langs
        give_back()


def _dump(words: list[bytes], *arrays: np.ndarray) -> bytes:
    """Words and arrays of non-negative integers, each in the narrowest type."""
    parts = []
    for a in (np.frombuffer(b" ".join(words), np.uint8), *arrays):
        top = int(a.max(initial=0))
        a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
        parts += [np.array([a.itemsize, len(a)], "<i8").tobytes(), a.tobytes()]
    return b"".join(parts)


def _load(data: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    out, at = [], 0
    while at < len(data):
        width, n = np.frombuffer(data, "<i8", 2, at).tolist()
        out.append(np.frombuffer(data, f"<u{width}", n, at + 16))
        at += 16 + width * n
    words = out[0].tobytes()
    return words.split(b" ") if words else [], [a.astype(np.int64) for a in out[1:]]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] places, then the same for the next."""
    return np.arange(int(size.sum())) + np.repeat(start - _starts(size), size)


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and their summed counts."""
    order = np.argsort(code)
    s = code[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[first], np.add.reduceat(n[order], first) if len(s) else n


# ------------------------------------------------------------------ ranges

def salt_of(lang: str) -> U64:
    return U64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def hashes(words: list[bytes]) -> np.ndarray:
    return words_of([b" ".join(words)], lower=False)[0]


def _range(key: np.ndarray, n: int) -> np.ndarray:
    return ((mix(key) >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def word_range(h: np.ndarray, salt: U64, n: int) -> np.ndarray:
    return _range(h ^ salt, n)


def pair_range(first: np.ndarray, second: np.ndarray, salt: U64, n: int) -> np.ndarray:
    return _range(mix(first ^ salt) * U64(0xC2B2AE3D27D4EB4F) + second, n)


# ------------------------------------------------------------------ count transducers

def _registered(size: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first state that is equal, for every state; the states that are their own first) of states with sorted arcs."""
    start = _starts(size)
    arc = mix(word.astype(U64) * U64(0x9E3779B97F4A7C15) + mix(count.astype(U64)))
    sums = np.concatenate([[U64(0)], np.cumsum(arc * (_spread(np.zeros_like(size), size).astype(U64) * U64(2) + U64(1)), dtype=U64)])
    key = mix(sums[start + size] - sums[start] + mix(size.astype(U64)))
    _, lead, which = np.unique(key, return_index=True, return_inverse=True)
    same = lead[which]
    # equal by their arcs, not by the hash alone
    fit = size == size[same]
    at = np.flatnonzero(fit)
    a, b = _spread(start[at], size[at]), _spread(start[same[at]], size[at])
    wrong = np.repeat(at, size[at])[(word[a] != word[b]) | (count[a] != count[b])]
    fit[wrong] = False
    same = np.where(fit, same, np.arange(len(size)))
    return same, np.flatnonzero(same == np.arange(len(size)))


def transducers(blob: bytes, salt: U64, n_shards: int) -> Iterator[tuple[int, bytes]]:
    """(range, automaton) of the words of ``blob`` (pieces end in a line feed)."""
    number = _Numbers({b"": 0, b"\n": 1})
    words = blob.replace(b"\n", b" \n ").split(b" ")
    v = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    del words
    v = v[v != 0] - 2
    vocab = list(number)[2:]
    if not vocab:
        return
    # words in byte order, so that the codes below are sorted phrases
    order = sorted(range(len(vocab)), key=vocab.__getitem__)
    rank = np.empty(len(vocab) + 1, np.int64)
    rank[order], rank[-1] = np.arange(len(vocab)), -1
    v, vocab, top = rank[v], [vocab[i] for i in order], len(vocab)
    h = hashes(vocab)
    one = np.bincount(v[v >= 0], minlength=top)
    near = (v[:-1] >= 0) & (v[1:] >= 0)
    pairs, which, two = np.unique((v[:-1] * top + v[1:])[near], return_inverse=True, return_counts=True)
    at = np.zeros(len(near), np.int64)
    at[near] = which
    long = near[:-1] & near[1:]
    tri, three = np.unique((at[:-1] * top + v[2:])[long], return_counts=True)
    first, second, head, third = pairs // top, pairs % top, tri // top, tri % top
    # ranges in order, and the sorted phrases of each
    shard1, shard2 = word_range(h, salt, n_shards), pair_range(h[first], h[second], salt, n_shards)
    by1, by2 = np.argsort(shard1, kind="stable"), np.argsort(shard2, kind="stable")
    size = np.bincount(head, minlength=len(pairs))
    by3 = _spread(_starts(size)[by2], size[by2])
    first, second, two, size, third, three = first[by2], second[by2], two[by2], size[by2], third[by3], three[by3]
    ends = np.cumsum(size)
    cut1, cut2 = (np.searchsorted(s, np.arange(n_shards + 1)) for s in (shard1[by1], shard2[by2]))
    for s in np.flatnonzero((np.diff(cut1) > 0) | (np.diff(cut2) > 0)).tolist():
        u, p = by1[cut1[s]:cut1[s + 1]], slice(int(cut2[s]), int(cut2[s + 1]))
        lo, hi = (int(ends[p.start] - size[p.start]), int(ends[p.stop - 1])) if p.stop > p.start else (0, 0)
        same, own = _registered(size[p], third[lo:hi], three[lo:hi])
        keep = lo + _spread(_starts(size[p])[own], size[p][own])
        used, local = np.unique(np.concatenate([u, first[p], second[p], third[keep]]), return_inverse=True)
        a, b, c, d = np.split(local, np.cumsum([len(u), len(same), len(same)]))
        yield s, _dump([vocab[i] for i in used], a, one[u], b, c, two[p], np.searchsorted(own, same), size[p][own], d, three[keep])


def _buffers(cols: dict) -> Iterator[tuple[str, bytes]]:
    """(language, lower-case pieces) of a chunk, cut at piece ends."""
    texts: dict[str, list[bytes]] = {}
    for t, lang in zip(cols["text"], cols["lang"]):
        if t:
            texts.setdefault(lang, []).append(t.lower().translate(_ENDS))
    for lang, parts in texts.items():
        blob = b"\n".join(parts)
        at = 0
        while at < len(blob):
            end = blob.find(b"\n", at + CHUNK)
            end = len(blob) if end < 0 else end
            yield lang, blob[at:end]
            at = end + 1


def _count(batches, n_shards: int) -> Iterator[pa.RecordBatch]:
    for cols in chunks(batches, "text", CHUNK):
        for lang, blob in _buffers(cols):
            rows = [_row(s, COUNTS, lang, data=d) for s, d in transducers(blob, salt_of(lang), n_shards)]
            if rows:
                yield _batch(rows)


# ------------------------------------------------------------------ union

class Automaton:
    """Words, and the paths of one, two and three words with their counts, as sorted arrays."""

    def __init__(self, data: bytes):
        self.words, (self.word, self.one, self.first, self.second, self.two, self.head, self.third, self.three) = _load(data)
        self.pair = self.first << 32 | self.second

    def numbers(self, words: list[bytes]) -> np.ndarray:
        own = {w: i for i, w in enumerate(self.words)}
        return np.array([own[w] for w in words], np.int64)


def united(blocks: list[bytes], least: int) -> tuple[int, bytes | None]:
    """(words counted, automaton of the phrases that occur at least ``least`` times) of a range."""
    number, parts = _Numbers(), []
    for data in blocks:
        words, (u, one, first, second, two, state, size, third, three) = _load(data)
        new = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        parts.append((new[u], one, new[first] << 32 | new[second], two, state, size, new[third], three))
    cat = lambda i: np.concatenate([p[i] for p in parts])
    word, one = _summed(cat(0), cat(1))
    total = int(one.sum())
    word, one = word[one >= least], one[one >= least]
    pair, two = _summed(cat(2), cat(3))
    pair, two = pair[two >= least], two[two >= least]
    code, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, _, own, _, state, size, third, three in parts:
        if not len(pair):
            break
        i = np.minimum(np.searchsorted(pair, own), len(pair) - 1)
        hit = np.flatnonzero(pair[i] == own)
        s = state[hit]
        arc = _spread(_starts(size)[s], size[s])
        code.append(np.repeat(i[hit], size[s]) << 32 | third[arc])
        count.append(three[arc])
    tri, three = _summed(np.concatenate(code), np.concatenate(count))
    tri, three = tri[three >= least], three[three >= least]
    if not len(word) and not len(pair):
        return total, None
    low = (1 << 32) - 1
    names = list(number)
    used = np.unique(np.concatenate([word, pair >> 32, pair & low, tri & low]))
    used = np.array(sorted(used.tolist(), key=names.__getitem__), np.int64)
    rank = np.zeros(len(names), np.int64)
    rank[used] = np.arange(len(used))
    by1 = np.argsort(rank[word])
    first, second = rank[pair >> 32], rank[pair & low]
    by2 = np.lexsort((second, first))
    place = np.empty(len(by2), np.int64)
    place[by2] = np.arange(len(by2))
    head, third = place[tri >> 32], rank[tri & low]
    by3 = np.lexsort((third, head))
    return total, _dump([names[i] for i in used], rank[word][by1], one[by1], first[by2], second[by2], two[by2],
                        head[by3], third[by3], three[by3])


class Questions:
    """The parts that an automaton's phrases need from other ranges, by range; the same on every call."""

    def __init__(self, auto: Automaton, lang: str, n_shards: int):
        salt, h = salt_of(lang), hashes(auto.words)
        self.word = np.unique(np.concatenate([auto.first, auto.second, auto.third]))
        code = auto.second[auto.head] << 32 | auto.third
        self.pair, self.of = np.unique(code, return_inverse=True)
        self.longest = np.zeros(len(self.pair), np.int64)
        np.maximum.at(self.longest, self.of, auto.three)
        self.x, self.y = self.pair >> 32, self.pair & (1 << 32) - 1
        to1, to2 = word_range(h[self.word], salt, n_shards), pair_range(h[self.x], h[self.y], salt, n_shards)
        self.by1, self.by2 = np.argsort(to1, kind="stable"), np.argsort(to2, kind="stable")
        self.targets = np.unique(np.concatenate([to1, to2]))
        self.cut1 = np.searchsorted(to1[self.by1], np.append(self.targets, n_shards))
        self.cut2 = np.searchsorted(to2[self.by2], np.append(self.targets, n_shards))

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(range, places in ``word``, places in ``pair``)."""
        for i, t in enumerate(self.targets.tolist()):
            yield t, self.by1[self.cut1[i]:self.cut1[i + 1]], self.by2[self.cut2[i]:self.cut2[i + 1]]


def _unite(batches, n_shards: int, least: int) -> Iterator[pa.RecordBatch]:
    for shard, langs in _by_shard(batches):
        for lang, rows in langs.items():
            n, data = united([r["data"] for r in rows], least)
            out = [_row(shard, TOTAL, lang, n=n)]
            if data is not None:
                auto = Automaton(data)
                out.append(_row(shard, AUTOMATON, lang, shard, data))
                q = Questions(auto, lang, n_shards)
                for target, w, p in q.parts():
                    used, local = np.unique(np.concatenate([q.word[w], q.x[p], q.y[p]]), return_inverse=True)
                    a, b, c = np.split(local, [len(w), len(w) + len(p)])
                    out.append(_row(target, ASKED, lang, shard, _dump([auto.words[i] for i in used], a, b, c, q.longest[p])))
            yield _batch(out)


# ------------------------------------------------------------------ composition

def _answer(batches, share: int) -> Iterator[pa.RecordBatch]:
    """Counts of the asked parts; and the places of this range's pairs that are mostly part of a longer candidate."""
    for shard, langs in _by_shard(batches):
        for lang, rows in langs.items():
            auto = Automaton(next(r["data"] for r in rows if r["kind"] == AUTOMATON))
            longest, out = np.zeros(len(auto.pair), np.int64), []
            for r in rows:
                if r["kind"] != ASKED:
                    continue
                words, (w, x, y, longer) = _load(r["data"])
                own = auto.numbers(words)
                i = np.searchsorted(auto.pair, own[x] << 32 | own[y])
                np.maximum.at(longest, i, longer)
                out.append(_row(r["source"], ANSWER, lang, shard,
                                _dump([], auto.one[np.searchsorted(auto.word, own[w])], auto.two[i])))
            inside = np.flatnonzero((longest > 0) & (100 * longest >= share * auto.two))
            out.append(_row(shard, INSIDE, lang, shard, _dump([], inside)))
            yield _batch(out)


def _cut(a: int, *parts: tuple[int, int]) -> tuple[int, int, int]:
    """(score, l, r) of the lowest-scoring cut, the first of equal ones."""
    score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(parts))
    return score, left, right


def _score(batches, n_shards: int, share: int, top: int) -> Iterator[pa.RecordBatch]:
    for shard, langs in _by_shard(batches):
        for lang, rows in langs.items():
            kinds = {k: [r for r in rows if r["kind"] == k] for k in (AUTOMATON, ANSWER, INSIDE)}
            auto = Automaton(kinds[AUTOMATON][0]["data"])
            q = Questions(auto, lang, n_shards)
            one, two = np.zeros(len(auto.words), np.int64), np.zeros(len(q.pair), np.int64)
            replies = {r["source"]: _load(r["data"])[1] for r in kinds[ANSWER]}
            for target, w, p in q.parts():
                one[q.word[w]], two[p] = replies[target]
            longest = np.zeros(len(auto.pair), np.int64)
            np.maximum.at(longest, auto.head, auto.three)
            gone = (longest > 0) & (100 * longest >= share * auto.two)
            for r in kinds[INSIDE]:
                gone[_load(r["data"])[1][0]] = True
            words, f1 = auto.words, one.tolist()
            first, second, f2 = auto.first.tolist(), auto.second.tolist(), auto.two.tolist()
            found = []
            for i in np.flatnonzero(~gone).tolist():
                x, y, a = first[i], second[i], f2[i]
                score, left, right = _cut(a, (f1[x], f1[y]))
                found.append((-score, -a, words[x] + b" " + words[y], left, right))
            for i, z, a, rest in zip(auto.head.tolist(), auto.third.tolist(), auto.three.tolist(), two[q.of].tolist()):
                x, y = first[i], second[i]
                score, left, right = _cut(a, (f1[x], rest), (f2[i], f1[z]))
                found.append((-score, -a, b" ".join((words[x], words[y], words[z])), left, right))
            found.sort()
            part = found[:top]
            if part:
                score, a, phrase, left, right = zip(*part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(part), pa.int32()), pa.array([lang] * len(part)),
                     pa.array(phrase, pa.binary()).cast(pa.string()), pa.array([-x for x in a], pa.int64()),
                     pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.array([-x for x in score], pa.int64())],
                    names=["shard", "lang", "phrase", "a", "l", "r", "score"])


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of 2 to 3 words of each language of ``docs`` (text string, lang string):
    lang, rank, phrase, a, l, r, n, score.  Candidates occur ``least`` times; one is dropped if a longer candidate that
    contains it has at least ``share`` percent of its count."""
    if least < 1:
        raise ValueError("least must be positive")
    spark = docs.sparkSession
    store = st.new_store(spark, "phrases")
    n = st.shards_of(docs)
    src = docs.select(F.col("text").cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    counts = src.mapInArrow(partial(_count, n_shards=n), SCHEMA).repartitionById(n, "shard")
    ranges = st.saved(counts.mapInArrow(partial(_unite, n_shards=n, least=least), SCHEMA), store, "ranges")
    asked = ranges.where(F.col("kind").isin(AUTOMATON, ASKED)).repartitionById(n, "shard")
    answers = st.saved(asked.mapInArrow(partial(_answer, share=share), SCHEMA), store, "answers")
    own = ranges.where(F.col("kind") == AUTOMATON).unionAll(answers).repartitionById(n, "shard")
    best = own.mapInArrow(partial(_score, n_shards=n, share=share, top=top), RESULT)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language has at most ``top`` rows of each range; groups of ranges are ranked first
    some = Window.partitionBy("lang", F.pmod("shard", F.lit(64))).orderBy(*order)
    all_ = Window.partitionBy("lang").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(all_).cast("long")).where(F.col("rank") <= top)
    total = ranges.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
