"""Token ids in Re-Pair compressed shards (operator 1).

*Encoding.*  Texts are cut before a space that follows a non-space character;
the tokenizer's splitting pattern has a boundary there in any context, so the
pieces' ids, joined, are the text's ids.  Words of letters with a full stop, a
comma or line feeds are cut there too, as the pattern does.  Each distinct part
is encoded once per chunk, by the tokenizers library.

*Grammar.*  A shard holds the ids of consecutive documents.  Re-Pair replaces
the most frequent pairs of neighbouring symbols by new symbols, round by round,
until no pair occurs ``min_count`` times.  A round replaces every pair that is at
least 1 / RANGE as frequent as the most frequent one; of overlapping places
the more frequent pair's are taken first, so a shard needs few passes.  No pair crosses a document's end, so a
document starts at a symbol.  Symbols and two numbers a rule, against the ids, on
average over seven shards of 262,144 ids:

    min_count 256   90 %      64   77 %      16   64 %      4   56 % (the default)

*File format.*  Parquet rows, one per shard, in ascending document order:
part, shard, start (ids before it in the part), doc_ids, sizes (ids per
document), symbols (symbols per document), rules (pairs of symbols, uint32),
lengths (ids that each rule expands to, uint32) and the sequence of symbols in
two planes, low (uint16) and high (the bits above, uint16).  Symbol s < ``base`` is an id; ``base`` + r is rule r.  ``document`` decodes one document of
a shard without the others, opening only the rules that its symbols use.

Documents are ordered by doc_id (nulls last), equal doc_ids by a hash of the
text, then by text.  Parts are ranges of doc_id; if one doc_id (or null) has more
rows than a part's even share, they are ranges of doc_id and hash.  A null text
is empty; the end id is appended to every document.  A document is never cut,
so a shard exceeds ``shard_ids`` by at most one document.  Extra columns are
ignored.  An empty table gives no shards.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st
from wattlake.llm.textvec import give_back

#: Bytes of text whose words are told apart together.
CHUNK = 8 << 20
#: Parts of words whose ids a worker process keeps between tasks (about 40 bytes each).
HELD = 1_000_000
#: A round takes the pairs from the most frequent one down to this fraction of it.
RANGE = 32
SHARD_SCHEMA = ("part int, shard int, start long, doc_ids binary, nulls binary, sizes binary, symbols binary,"
                " base int, rules binary, lengths binary, low binary, high binary, n_ids long")
#: What may be read as white space before a space; a text that has it is cut more carefully.
#: (Controls, U+0085, U+00A0, U+1680, U+180E, U+2000-U+206F, U+3000, U+FEFF: more than any definition of white space.)
_BLANK = "\x01-\x20\x7f\x85\xa0\u1680\u180e\u2000-\u206f\u3000\ufeff"
_ODD = f"^ |[{_BLANK}\\x{{0}}] "
_CUT = re.compile(f"(?<=[^\x00{_BLANK}]) ")
#: Parts that are encoded alone: what ends in white space, or holds a space.
_APART = f"(?s)^.+ |[{_BLANK}\\x{{0}}]\\z"
#: Letters that every version of the tokenizer's pattern calls so (U+00C0 to U+024F without the two signs).
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
#: Words that the pattern cuts at every full stop, comma and line feed; and the parts it cuts them into.
_PLAIN = f"^{_LETTERS}[.,]?(\n{_LETTERS}[.,]?)*$"
_PART = f"^( ?{_LETTERS}|[.,]|\n)$"
#: Parts that are encoded as one text.
_JOINED = 200


def words_of(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """(pieces that encode independently, offsets): all but a text's first piece are given without their leading space."""
    odd = np.flatnonzero(pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False))
    lists = pc.split_pattern(texts, " ")
    words, off = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    if not len(odd):
        return words, off
    blocks, at, count = [], 0, np.diff(off)
    for i, text in zip(odd.tolist(), texts.take(pa.array(odd)).to_pylist()):
        cut = _CUT.split(text)
        blocks += [words.slice(at, off[i] - at), pa.array(cut, pa.string())]
        at, count[i] = off[i + 1], len(cut)
    return pa.concat_arrays([*blocks, words.slice(at)]), np.concatenate([[0], np.cumsum(count)])


def _picked(ids: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Lists of ``size`` ids each, taken in the order of ``which`` and joined."""
    off = np.concatenate([[0], np.cumsum(size)])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids)).take(pa.array(which)).flatten().to_numpy()


class Encoder:
    """Ids of texts by the tokenizers library, each distinct part of the words encoded once.

    Arrow's dictionaries tell the words of a chunk apart, and the parts of its
    distinct words.  Parts met before, at most ``held`` and a chunk's, are kept
    as one Arrow array with their ids.
    """

    def __init__(self, path: str, held: int = HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit
        self.tokenizer, self.held, self.cut = Tokenizer.from_file(path), held, None
        letters = {c: 1 for c in ByteLevel.alphabet()}  # one character stands for one byte
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token) if all(c in letters for c in token) else len(token.encode())
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        usual = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                 "byte_fallback": False, "ignore_merges": False}
        if (split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
                and not spec.get("normalizer") and model.get("type") == "BPE" and all((model.get(k) or v) == v for k, v in usual.items())
                and not any(re.fullmatch(rf"[ .,\n]*({_LETTERS}[ .,\n]*)*", t) for t in self.added)):
            # the same merges on parts that are cut already; no part comes twice, so the library need not remember them
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
            self.cut = Tokenizer(BPE(model["vocab"], merges, cache_capacity=0))
            self.cut.pre_tokenizer = CharDelimiterSplit(" ")
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(seen)]
        # the byte-level alphabet; a zero byte, which no such part has, ends a part
        self.character = np.arange(256, dtype="<u4")
        self.character[hidden] = 256 + np.arange(len(hidden))
        self.character[0] = 32
        self.clear()

    def clear(self) -> None:
        self.parts, self.size, self.ids = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _encode(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts, joined; ids per text)."""
        got = [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int64, len(got))

    def _together(self, parts: pa.StringArray, mark: str, read, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per part) of parts that are joined by ``mark`` and encoded many at a time."""
        groups = pa.array([*range(0, len(parts), _JOINED), len(parts)], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(groups, parts), mark).to_pylist()
        ids, _ = self._encode([read(t) for t in texts], tokenizer)
        # an id covers a known number of bytes, so the parts' ends are found in the joined ids
        ends = np.cumsum(pc.binary_length(parts).to_numpy().astype(np.int64))
        return ids, np.diff(np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1, prepend=0)

    def _spelt(self, text: str) -> str:
        """The text in the byte-level alphabet."""
        return self.character[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")

    def _learn(self, fresh: pa.StringArray) -> np.ndarray:
        """Encode unknown parts; returns their places among the known ones."""
        plain = pc.match_substring_regex(fresh, _PART).to_numpy(zero_copy_only=False) & (self.cut is not None)
        alone = pc.match_substring_regex(fresh, _APART)
        for t in self.added:
            alone = pc.or_(alone, pc.match_substring(fresh, t))
        alone = alone.to_numpy(zero_copy_only=False) & ~plain
        kind = np.where(plain, 0, np.where(alone, 2, 1))
        order = np.argsort(kind, kind="stable")
        fresh = fresh.take(pa.array(order))
        n = np.bincount(kind, minlength=3)
        got = [self._together(fresh[:n[0]], "\0", self._spelt, self.cut) if n[0] else None,
               self._together(fresh[n[0]:n[0] + n[1]], "", str, self.tokenizer) if n[1] else None,
               self._encode(fresh[n[0] + n[1]:].to_pylist()) if n[2] else None]
        place = np.empty(len(order), np.int64)
        place[order] = len(self.parts) + np.arange(len(order))
        self.parts = pa.concat_arrays([self.parts, fresh])
        self.ids = np.concatenate([self.ids, *(g[0] for g in got if g)])
        self.size = np.concatenate([self.size, *(g[1] for g in got if g)])
        return place

    def _parts(self, words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """(parts of the words, parts per word, which of these each word is)."""
        spaced = pc.binary_join_element_wise(" ", words, "")
        plain = pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False) & (self.cut is not None)
        x = spaced.filter(pa.array(plain))
        for old, new in ((".", "\0."), (",", "\0,"), ("\n", "\0\n\0")):
            x = pc.replace_substring(x, old, new)
        lists = pc.split_pattern(x, "\0")
        place = np.argsort(~plain, kind="stable")
        which = np.empty(len(words), np.int64)
        which[place] = np.arange(len(words))
        count = np.concatenate([np.diff(lists.offsets.to_numpy()), np.ones(len(words) - len(x), np.int64)])
        return pa.concat_arrays([lists.flatten(), spaced.filter(pa.array(~plain))]), count, which

    def encode(self, texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end id, ids per text); null texts are empty."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words, off = words_of(texts)
        first = words.take(pa.array(off[:-1]))
        words = words.dictionary_encode()
        parts, count, which = self._parts(words.dictionary)
        parts = parts.dictionary_encode()
        if len(self.parts) > self.held:
            self.clear()
        at = pc.index_in(parts.dictionary, value_set=self.parts)
        fresh = at.is_null()
        at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        if at.min() < 0:
            at[at < 0] = self._learn(parts.dictionary.filter(fresh))
        at = at[parts.indices.to_numpy()]
        # the distinct words, then the texts' first pieces, then the end id
        first, first_size = self._encode(first.to_pylist())
        size = np.concatenate([np.add.reduceat(self.size[at], np.cumsum(count) - count), first_size, [1]])
        ids = np.concatenate([_picked(self.ids, self.size, at), first, np.array([end], np.int32)])
        n, texts_n = len(count), len(off) - 1
        which = np.insert(which[words.indices.to_numpy()], off[1:], n + texts_n)
        at = off[:-1] + np.arange(texts_n)
        which[at] = n + np.arange(texts_n)
        return _picked(ids, size, which), np.add.reduceat(size[which], at)


def text_blocks(batches, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) of Arrow batches, cut after about every ``limit`` bytes of text."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index("text"))), 0).to_numpy().astype(np.int64) + 64)
        lo = before = 0
        while lo < len(ends):
            hi = int(np.searchsorted(ends, before + limit - size)) + 1
            held.append(batch.slice(lo, min(hi, len(ends)) - lo))
            if hi > len(ends):
                size += int(ends[-1]) - before
                break
            yield joined()
            held, size, lo, before = [], 0, hi, int(ends[hi - 1])
    if held:
        yield joined()
    give_back()


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(tokenizer: str) -> Encoder:
    """The worker process's encoder: the parts it has met in earlier tasks are known (at most HELD and one chunk's)."""
    if tokenizer not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]


def _ordered(code: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(the codes in order, which place each is from); a code is below ``top`` squared."""
    bits = len(code).bit_length()
    if 2 * int(top).bit_length() + bits > 62:
        order = np.argsort(code, kind="stable")
        return code[order], order
    # a code and its place in one number: a plain sort is faster than one of places
    key = code << bits
    key |= np.arange(len(code))
    key.sort()
    return key >> bits, key & (1 << bits) - 1


def _disjoint(rank: np.ndarray, touch: np.ndarray) -> np.ndarray:
    """Which places to replace, smallest rank first, none overlapping; ``touch[i]``: places i and i + 1 overlap.

    In a run of one pair (a symbol repeated) every other place from the left comes first.
    """
    n = len(rank)
    same = np.zeros(n, bool)
    same[1:] = touch & (rank[1:] == rank[:-1])
    at = np.arange(n)
    key = 2 * rank + (at - np.maximum.accumulate(np.where(same, 0, at)) & 1)
    kept, left = np.zeros(n, bool), at
    while len(left):
        low = np.ones(len(left), bool)
        low[1:] &= ~touch | (key[1:] < key[:-1])
        low[:-1] &= ~touch | (key[:-1] < key[1:])
        kept[left[low]] = True
        gone = low.copy()
        gone[1:] |= touch & low[:-1]
        gone[:-1] |= touch & low[1:]
        stays = np.flatnonzero(~gone)
        # what stays between two that went is a neighbour of neither
        touch = touch[stays[:-1]] & (np.diff(stays) == 1)
        left, key = left[stays], key[stays]
    return kept


def repair(ids: np.ndarray, sizes: np.ndarray, base: int, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair grammar of a shard: (rules, expansion lengths, sequence, symbols per document)."""
    # the shard's own symbols: its distinct ids in order, then the rules
    there = np.bincount(ids)
    own = np.flatnonzero(there)
    number = np.zeros(len(there), np.int64)
    number[own] = np.arange(len(own))
    s = number.take(ids)
    # the live symbols as a linked list that ends with each document
    after, before = np.arange(1, len(s) + 1), np.arange(-1, len(s) - 1)
    alive = np.ones(len(s), bool)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    after[first - 1] = -1  # of the document before; the first one's wraps to the last symbol
    before[first] = -1
    # A pair once rarer than min_count stays so: later rounds look only at the frequent pairs' places and the new symbols.
    place = np.flatnonzero(after >= 0)
    rules: list[np.ndarray] = []
    top = len(own)
    while len(place):
        code, order = _ordered(s.take(place) * top + s.take(after.take(place)), top)
        new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        pairs, n = code[new], np.diff(np.append(new, len(code)))
        most = int(n.max())
        if most < min_count:
            break
        chosen = np.flatnonzero(n >= max(min_count, -(-most // RANGE)))
        by_rank = chosen[np.lexsort((pairs[chosen], -n[chosen]))]
        # of every place its pair's rank; -1: a later round's pair, -2: too rare a pair
        rank_of = np.where(n < min_count, -2, -1)
        rank_of[by_rank] = np.arange(len(by_rank))
        ranks = np.empty(len(code), np.int64)
        ranks[order] = np.repeat(rank_of, n)
        now = np.flatnonzero(ranks >= 0)
        hit, rank = place.take(now), ranks.take(now)
        place = place[ranks > -2]
        kept = _disjoint(rank, after[hit[:-1]] == hit[1:])
        hit, rank = hit[kept], rank[kept]
        used = np.flatnonzero(np.bincount(rank, minlength=len(by_rank)))
        name = np.empty(len(by_rank), np.int64)
        name[used] = top + np.arange(len(used))
        pair = pairs[by_rank[used]]
        rules.append(np.stack([pair // top, pair % top], 1))
        s[hit] = name.take(rank)
        top += len(used)
        gone = after[hit]
        alive[gone] = False
        then = after[gone]
        after[hit] = then
        before[then[then >= 0]] = hit[then >= 0]
        left = before[hit]
        look = np.zeros(len(s), bool)
        look[place] = look[left[left >= 0]] = True
        look[gone] = look[hit[then < 0]] = False
        place = np.flatnonzero(look)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    name_of = np.concatenate([own, base + np.arange(len(table))])
    length = np.ones(top, np.int64)
    done = len(own)
    for block in rules:  # a rule only names symbols of earlier rounds
        length[done:done + len(block)] = length[block].sum(1)
        done += len(block)
    left, end = np.concatenate([[0], np.cumsum(alive)]), np.cumsum(sizes)
    return name_of[table], length[len(own):], name_of[s[alive]], left[end] - left[end - sizes]


def expand(sequence: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    sequence, rules = sequence.astype(np.int64), rules.astype(np.int64).reshape(-1, 2)
    lengths = lengths.astype(np.int64)
    return _picked(np.concatenate([np.arange(base), _rule_ids(rules, lengths, base)]),
                   np.concatenate([np.ones(base, np.int64), lengths]), sequence)


def _rule_ids(rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """Expansions of all rules, one after the other."""
    end = np.cumsum(lengths)
    start = end - lengths
    # symbol and place of every rule's two halves; halves that are rules are opened level by level
    left = np.where(rules[:, 0] >= base, lengths[np.maximum(rules[:, 0] - base, 0)], 1) if len(rules) else lengths
    sym = rules.ravel()
    place = np.stack([start, start + left], 1).ravel()
    flat = np.zeros(int(end[-1]) if len(end) else 0, np.int64)
    while len(sym):
        plain = sym < base
        flat[place[plain]] = sym[plain]
        r, at = sym[~plain] - base, place[~plain]
        sym = rules[r].ravel()
        place = np.stack([at, at + left[r]], 1).ravel()
    return flat


def sequence_of(shard: dict) -> np.ndarray:
    return np.frombuffer(shard["low"], np.uint16).astype(np.int64) | np.frombuffer(shard["high"], np.uint16).astype(np.int64) << 16


def document(shard: dict, i: int) -> np.ndarray:
    """Ids of the i-th document of a shard row, from its own symbols."""
    count = np.frombuffer(shard["symbols"], np.uint32).astype(np.int64)
    lo, base = int(count[:i].sum()), shard["base"]
    part = slice(lo, lo + int(count[i]))
    sequence = (np.frombuffer(shard["low"], np.uint16)[part].astype(np.int64)
                | np.frombuffer(shard["high"], np.uint16)[part].astype(np.int64) << 16)
    rules, lengths = np.frombuffer(shard["rules"], np.uint32).reshape(-1, 2), np.frombuffer(shard["lengths"], np.uint32)
    used, fresh = np.zeros(0, np.int64), np.unique(sequence[sequence >= base])
    while len(fresh):
        used = np.union1d(used, fresh)
        halves = rules[fresh - base].astype(np.int64).ravel()
        fresh = np.setdiff1d(halves[halves >= base], used)

    def named(symbols: np.ndarray) -> np.ndarray:
        """The same symbols, with rules numbered among the used ones."""
        return np.where(symbols < base, symbols, base + np.searchsorted(used, symbols))

    return expand(named(sequence), named(rules[used - base].astype(np.int64)), lengths[used - base], base)


def _write(batches, path: str, end: int, base: int, shard_ids: int, min_count: int) -> Iterator[pa.RecordBatch]:
    part, encoder, start, number = ex.pid(), worker_encoder(path), 0, 0
    held: list[tuple[list, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal start, number, held, size
        docs = [d for x in held for d in x[0]]
        ids, sizes = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
        rules, lengths, sequence, symbols = repair(ids, sizes, base, min_count)
        u32 = lambda a: a.astype(np.uint32).tobytes()
        row = [part, number, start, np.array([d or 0 for d in docs], np.int64).tobytes(),
               np.array([d is None for d in docs], np.uint8).tobytes(), sizes.astype(np.int64).tobytes(), u32(symbols), base,
               u32(rules.ravel()), u32(lengths), (sequence & 0xFFFF).astype(np.uint16).tobytes(),
               (sequence >> 16).astype(np.uint16).tobytes(), len(ids)]
        start, number, held, size = start + len(ids), number + 1, [], 0
        return pa.RecordBatch.from_pylist([dict(zip(_SHARD.names, row))], schema=_SHARD)

    for block in text_blocks(batches, CHUNK):
        doc_ids = block.column(block.schema.names.index("doc_id")).to_pylist()
        ids, sizes = encoder.encode(block.column(block.schema.names.index("text")), end)
        at = np.concatenate([[0], np.cumsum(sizes)])
        lo = 0
        while lo < len(sizes):
            hi = int(np.searchsorted(at, at[lo] + shard_ids - size, side="left"))
            hi = min(max(hi, lo + 1), len(sizes))
            held.append((doc_ids[lo:hi], ids[at[lo]:at[hi]], sizes[lo:hi]))
            size += int(at[hi] - at[lo])
            if size >= shard_ids:
                yield flush()
            lo = hi
    if held:
        yield flush()


_SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.binary()),
                    ("nulls", pa.binary()), ("sizes", pa.binary()), ("symbols", pa.binary()), ("base", pa.int32()),
                    ("rules", pa.binary()), ("lengths", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("n_ids", pa.int64())])


def _digest(batches) -> Iterator[pa.RecordBatch]:
    """Per document of the read shards: doc_id, start, n_tokens, ids_crc32."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = expand(sequence_of(row), np.frombuffer(row["rules"], np.uint32),
                         np.frombuffer(row["lengths"], np.uint32), row["base"]).astype("<u4")
            sizes = np.frombuffer(row["sizes"], np.int64)
            if len(ids) != row["n_ids"] or int(sizes.sum()) != len(ids):
                raise ValueError(f"shard {row['part']}/{row['shard']} is damaged")
            end = np.cumsum(sizes)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(end.tolist(), sizes.tolist())]
            nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=nulls),
                "start": pa.array(row["base_start"] + row["start"] + end - sizes), "n_tokens": pa.array(sizes),
                "ids_crc32": pa.array(np.array(crc, np.int64)), "n_symbols": pa.array(
                    np.frombuffer(row["symbols"], np.uint32).astype(np.int64))})


def write_shards(docs: DataFrame, path: str, tokenizer: str, end: int = 2, base: int = 1 << 17,
                 shard_ids: int = 1 << 18, min_count: int = 4) -> DataFrame:
    """Write ``docs`` (doc_id bigint, text string) as shards under ``path``; returns the shard rows as read back."""
    spark = docs.sparkSession
    st.ship(spark)
    n = st.shards_of(docs)
    by_id, by_hash = F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    share = docs.groupBy("doc_id").count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    hot = share["rows"] is not None and share["most"] * n > share["rows"]
    rows = (docs.select("doc_id", "text").repartitionByRange(n, by_id, *([by_hash] if hot else []))
            .sortWithinPartitions(by_id, by_hash, "text"))
    rows.mapInArrow(partial(_write, path=tokenizer, end=end, base=base, shard_ids=shard_ids, min_count=min_count),
                    SHARD_SCHEMA).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """Decode shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, n_symbols."""
    # one row per written part, a number the writer chose: the running sum is over that many rows
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    before, rows = 0, []
    for r in sorted(totals, key=lambda r: r["part"]):
        rows.append((r["part"], before))
        before += r["n"]
    starts = shards.sparkSession.createDataFrame(rows, "part int, base_start long")
    return shards.join(F.broadcast(starts), "part").mapInArrow(
        _digest, "doc_id long, start long, n_tokens long, ids_crc32 long, n_symbols long")


def tokenize_corpus(docs: DataFrame, tokenizer: str, end: int = 2, path: str | None = None) -> DataFrame:
    """Write the shards (to ``path``, or to a fresh shared folder) and digest them from the files."""
    path = path or f"{st.new_store(docs.sparkSession, 'tokens')}/shards"
    return read_documents(write_shards(docs, path, tokenizer, end))
